"""Code-to-label maps.

Fixed values: these labels must equal the source's for the output tables to match. They are stated as
given, in their natural order. Any job takes its map as a parameter; these are only the defaults.
"""

# Ad campaign status codes (unknown codes are kept as text, SCA-1).
CAMPAIGN_STATUS = {
    -1: "Кампания в процессе удаления",
    4: "Готова к запуску",
    7: "Кампания завершена",
    8: "Отказался",
    9: "Идут показы",
    11: "Кампания на паузе",
}

# Ad campaign type codes (unknown codes are kept as text, SCA-1).
CAMPAIGN_TYPE = {
    4: "Кампания в каталоге (устаревший тип)",
    5: "Кампания в карточке товара (устаревший тип)",
    6: "Кампания в поиске (устаревший тип)",
    7: "Кампания в рекомендациях на главной странице (устаревший тип)",
    8: "Автоматическая кампания",
    9: "Аукцион",
}

# The shorter type labels used by the window-reload job.
CAMPAIGN_TYPE_SHORT = {
    4: "Кампания в каталоге",
    5: "Кампания в карточке товара",
    6: "Кампания в поиске",
    7: "Кампания в рекомендациях",
    8: "Автоматическая кампания",
    9: "Аукцион",
}

# Performance-campaign maps (unknown values become null, SCA-2; placement keeps unknowns).
PAYMENT_TYPE = {
    "CPC": "за клики",
    "CPM": "за показы",
    "CPA": "за действия",
    "CAMPAIGN_TYPE_INVALID": "неизвестно",
}
CAMPAIGN_STATE = {
    "CAMPAIGN_STATE_RUNNING": "активная кампания",
    "CAMPAIGN_STATE_PLANNED": "кампания, сроки проведения которой ещё не наступили",
    "CAMPAIGN_STATE_STOPPED": "кампания, приостановленная из-за нехватки бюджета",
    "CAMPAIGN_STATE_INACTIVE": "кампания, остановленная владельцем",
    "CAMPAIGN_STATE_ARCHIVED": "архивная кампания",
    "CAMPAIGN_STATE_MODERATION_DRAFT": "отредактированная кампания до отправки на модерацию",
    "CAMPAIGN_STATE_MODERATION_IN_PROGRESS": "кампания, отправленная на модерацию",
    "CAMPAIGN_STATE_MODERATION_FAILED": "кампания, непрошедшая модерацию",
    "CAMPAIGN_STATE_FINISHED": "кампания завершена",
    "CAMPAIGN_STATE_UNKNOWN": "состояние неизвестно",
}
ADV_OBJECT_TYPE = {
    "SKU": "Трафареты или Вывод в топ",
    "BANNER": "Баннерная рекламная кампания",
    "SEARCH_PROMO": "Продвижение в поиске",
}
PLACEMENT = {
    "PLACEMENT_INVALID": "не определено",
    "PLACEMENT_PDP": "карточка товара",
    "PLACEMENT_SEARCH_AND_CATEGORY": "поиск и категории",
    "PLACEMENT_TOP_PROMOTION": "вывод в топ",
    "PLACEMENT_TAKEOVER": "одновременный показ товаров",
}
AUTOPILOT_STRATEGY = {
    "MAX_VIEWS": "максимальное количество показов",
    "MAX_CLICKS": "максимальное количество кликов",
    "TOP_MAX_CLICKS": "максимальное количество кликов для Вывода в топ",
    "NO_AUTO_STRATEGY": "автостратегия не используется",
    "TAKEOVER": "одновременный показ товаров",
}
CAMPAIGN_MODE = {
    "PRODUCT_CAMPAIGN_MODE_AUTO": "автоматически",
    "PRODUCT_CAMPAIGN_MODE_MANUAL": "вручную",
}

# Marketplace names written into the Marketplace column.
MARKETPLACE_WB = "Wildberries"
MARKETPLACE_OZON = "Ozon"

# Load-audit status texts (SNK-11).
AUDIT_OK = "Successful"
AUDIT_ERROR = "Error"

# Fixed value: the source tag written into the realization tables (PRJ-15).
REALIZATION_SOURCE = "WB-Realization-API"

# Fixed value: the sentinel written for a missing date (SCA-10).
NULL_DATE_SENTINEL = "2100-01-01"
