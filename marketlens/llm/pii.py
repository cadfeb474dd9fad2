"""Operator 6 [native]: format-preserving pseudonyms for personal data.

E-mail addresses, IPv4 addresses, card numbers (Luhn), IBANs (mod 97), phone numbers, US social security numbers and dates are found by
patterns and validated; each is replaced by another value of the same format, by a keyed Feistel permutation of the values of that format.
Equal values get equal pseudonyms in every document, in whatever notation they stand (a phone number with spaces or without, a day written
year, day or month first), different ones different pseudonyms, and whoever has the key can undo it.

Everything is DataFrame functions: the text is split at the matches, the matches are transformed, and both are joined again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.llm.common import read_table

ROUNDS = 10

# Possessive parts and looks behind keep each pattern linear in the text. Of a domain's labels (a name has 127 at most), the last that begins
# with an alphabetic one ends the address, so that hyphens, dots and digits after it cost no match.
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
# A local part has 64 characters at most: longer ones are no address.
EMAIL = r"(?<![A-Za-z0-9._%+\-])[A-Za-z0-9._%+\-]{1,64}+@[A-Za-z0-9\-]++(?:\.[A-Za-z0-9\-]++){0,125}\.[A-Za-z]{2,24}(?![A-Za-z0-9])"
IPV4 = rf"(?<![\d.]){_OCTET}(?:\.{_OCTET}){{3}}(?!\d|\.\d)"
DATE = (r"(?<![\d./\-])(?:(?:1[7-9]|20)\d\d(?<ymd>[./\-])(?:0[1-9]|1[0-2])\k<ymd>(?:0[1-9]|[12]\d|3[01])"
        r"|(?:0?[1-9]|[12]\d|3[01])(?<sep>[./\-])(?:0?[1-9]|[12]\d|3[01])\k<sep>(?:1[7-9]|20)\d\d)(?![\d\-/]|\.\d)")
SSN = r"(?<![\d\-])(?!000|666|9)\d{3}-(?!00)\d\d-(?!0000)\d{4}(?![\d\-])"
_INTER = r"(?:\+|00[ .\-]?)(?=[1-9])"
PHONE = (rf"(?<![\d+])(?:{_INTER}1[ .\-]?(?:\(\d{{3}}\)|\d{{3}})[ .\-]?\d{{3}}[ .\-]?\d{{4}}"
         rf"|{_INTER}\d{{1,3}}[ .\-]?\(0\)[ .\-]?\d{{2,4}}(?:[ .\-]?\d{{2,4}}){{1,3}}"
         rf"|{_INTER}\d{{1,3}}[ .\-]?\(\d{{1,4}}\)[ .\-]?\d{{3,4}}[ .\-]?\d{{3,4}}|{_INTER}\d{{1,3}}(?:[ \-]\d{{2,4}}){{2,4}}(?![ \-]?\d)"
         rf"|{_INTER}\d{{1,3}}[ \-]\d{{1,5}}[ \-]\d{{4,9}}|{_INTER}\d{{1,3}}(?:[ \-]\d{{2,4}}){{2,4}}"
         rf"|\+(?!{_OCTET}(?:\.{_OCTET}){{3}}(?!\d|\.\d))\d{{1,3}}(?:\.\d{{2,4}}){{2,4}}|\+\d{{7,15}})(?!\.?\d)"
         r"|(?<![\d.\-(])(?:1[ .\-]|1(?=\())?(?:\(\d{3}\) ?|\d{3}[ .\-])\d{3}[ .\-]\d{4}(?![\d.\-]?\d)")
# The country calling codes of two digits. 1 and 7 stand alone, all others have three; no code begins another.
TWO_DIGIT_CODES = ("20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 "
                   "90 91 92 93 94 95 98").split()
IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}\d\d(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"
# In one run of digits, or in groups with the same separator: a looser pattern would run on into a number that follows.
CARD = r"(?<!\d)(?:\d{13,19}|\d{4}(?<gap>[ \-])\d{4}\k<gap>\d{4}\k<gap>\d{1,7}|\d{4}[ \-]\d{6}[ \-]\d{4,5})(?!\d)"
# The order decides between kinds that start at the same place.
KINDS = {"email": EMAIL, "iban": IBAN, "ipv4": IPV4, "date": DATE, "ssn": SSN, "phone": PHONE, "card": CARD}

# The 400 years of the Gregorian cycle from here on have 4,800 months: 57,600 days of the month 1 to 12 (240 times 240), and 88,497 later
# ones (9 times 9,833). Each part is permuted in itself: only the later days can be told as month first, so a date written month first
# is again one, and a day has the same pseudonym in every notation.
FIRST_DAY = "1700-01-01"
EARLY_DAYS = 12
EARLY_SIZES, LATE_SIZES = (240, 240), (9, 9833)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _feistel(high: Column, low: Column, high_size: Column, low_size: Column, tweak: Column, key: str) -> Column:
    """Keyed permutation of the pairs (high, low): struct of high and low, each below its size (at most 10^9)."""
    def turn(state: Column, i: Column) -> Column:
        even = i % 2 == 0
        other = F.when(even, state["low"]).otherwise(state["high"])
        digest = F.sha2(F.concat_ws(":", F.lit(key), tweak, i.cast("string"), other.cast("string"), F.lit(key)), 256)
        add = F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")
        return F.struct(F.when(even, (state["high"] + add % high_size) % high_size).otherwise(state["high"]).alias("high"),
                        F.when(even, state["low"]).otherwise((state["low"] + add % low_size) % low_size).alias("low"))

    first = F.struct(high.cast("long").alias("high"), low.cast("long").alias("low"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), first, turn)


def _power(base: int, exponent: Column) -> Column:
    return F.element_at(F.array(*(F.lit(base**k) for k in range(10))), (exponent + 1).cast("int"))


def _permute_digits(digits: Column, tweak: Column, key: str) -> Column:
    """Another string of as many digits, for 1 to 18 of them."""
    def body(n: Column) -> Column:
        u = F.floor(n / 2).cast("int")
        v = n - u
        pair = _feistel(F.when(u > 0, F.substr(digits, F.lit(1), u).cast("long")).otherwise(F.lit(0)),
                        F.substr(digits, u + 1, v).cast("long"), _power(10, u), _power(10, v), tweak, key)
        return _let(pair, lambda p: F.concat(F.when(u > 0, F.lpad(p["high"].cast("string"), u, "0")).otherwise(F.lit("")),
                                             F.lpad(p["low"].cast("string"), v, "0")))

    return _let(F.length(digits), body)


def _permute_letters(letters: Column, tweak: Column, key: str) -> Column:
    """Another string of as many letters a-z, for 1 to 12 of them."""
    def number(s: Column) -> Column:
        return F.aggregate(F.split(s, ""), F.lit(0).cast("long"),
                           lambda acc, c: F.when(c == "", acc).otherwise(acc * 26 + F.ascii(c) - 97))

    def text(x: Column, n: Column) -> Column:
        return F.when(n == 0, F.lit("")).otherwise(F.array_join(F.transform(
            F.sequence(n - 1, F.lit(0), F.lit(-1)), lambda k: F.char((97 + F.floor(x / _power(26, k)) % 26).cast("long"))), ""))

    def body(n: Column) -> Column:
        u = F.floor(n / 2).cast("int")
        v = n - u
        pair = _feistel(number(F.substr(letters, F.lit(1), u)), number(F.substr(letters, u + 1, v)), _power(26, u), _power(26, v), tweak, key)
        return _let(pair, lambda p: F.concat(F.when(u > 0, text(p["high"], F.greatest(u, F.lit(1)))).otherwise(F.lit("")), text(p["low"], v)))

    return _let(F.length(letters), body)


def _in_blocks(s: Column, size: int, permute: Callable[[Column, Column, str], Column], tweak: Column, key: str) -> Column:
    """Permute a string in blocks of at most ``size`` characters; each block has a tweak of its own."""
    blocks = F.ceil(F.length(s) / size).cast("int")
    return F.when(F.length(s) == 0, F.lit("")).otherwise(F.array_join(F.transform(
        F.sequence(F.lit(1), F.greatest(blocks, F.lit(1))),
        lambda i: permute(F.substr(s, (i - 1) * size + 1, F.lit(size)), F.concat_ws("/", tweak, F.length(s).cast("string"), i.cast("string")), key)), ""))


def _refill(template: Column, digits: Column, letters: Column | None = None) -> Column:
    """The template with its digits, and its letters if given, replaced in order; letters keep their case."""
    no_letters = F.lit("") if letters is None else letters

    def put(state: Column, c: Column) -> Column:
        is_digit = c.between("0", "9") & (c != "")
        is_letter = F.lit(False) if letters is None else c.rlike("^[A-Za-z]$")
        letter = F.substr(no_letters, state["l"], F.lit(1))
        return F.struct(
            F.concat(state["out"], F.when(is_digit, F.substr(digits, state["d"], F.lit(1)))
                     .when(is_letter, F.when(c.between("A", "Z"), F.upper(letter)).otherwise(letter)).otherwise(c)).alias("out"),
            (state["d"] + is_digit.cast("int")).alias("d"), (state["l"] + is_letter.cast("int")).alias("l"))

    return F.aggregate(F.split(template, ""), F.struct(F.lit("").alias("out"), F.lit(1).alias("d"), F.lit(1).alias("l")), put, lambda s: s["out"])


def _digits_of(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def _luhn_sum(digits: Column, doubled_last: bool) -> Column:
    """Luhn sum from the right; ``doubled_last`` for a payload whose check digit is still to come."""
    values = F.split(F.reverse(digits), "")
    return F.aggregate(values, F.struct(F.lit(0).alias("sum"), F.lit(doubled_last).alias("twice")), lambda s, c: F.when(c == "", s).otherwise(
        _let(c.cast("int"), lambda d: F.struct((s["sum"] + F.when(s["twice"], F.when(d > 4, 2 * d - 9).otherwise(2 * d)).otherwise(d)).alias("sum"),
                                               (~s["twice"]).alias("twice")))), lambda s: s["sum"])


def _card(m: Column, key: str) -> Column:
    """Same length, separators and first digit; the check digit is right. Null if the number fails the Luhn test."""
    def body(d: Column) -> Column:
        inner = F.concat(F.substr(d, F.lit(1), F.lit(1)), _permute_digits(F.substr(d, F.lit(2), F.length(d) - 2),
                                                                            F.concat(F.lit("card"), F.substr(d, F.lit(1), F.lit(1)), F.length(d).cast("string")), key))
        new = _let(inner, lambda p: F.concat(p, ((10 - _luhn_sum(p, True) % 10) % 10).cast("string")))
        return F.when((_luhn_sum(d, False) % 10 == 0) & (d.cast("decimal(19,0)") > 0), _refill(m, new))

    return _let(_digits_of(m), body)


def _phone(m: Column, key: str) -> Column:
    """The prefix (+ or 00), the country code, a (0) after it and the layout stay; the national digits are permuted by the country code, so
    that a number has one pseudonym however it is written. Numbers without prefix are North American. Null unless it has 7 to 15 digits."""
    def body(d: Column) -> Column:
        zeros = m.startswith("00")
        inter = m.startswith("+") | zeros
        e = F.when(zeros, F.substr(d, F.lit(3), F.length(d))).otherwise(d)
        code = F.when(~inter, F.lit("1")).when(e.rlike("^[17]"), F.substring(e, 1, 1)).when(
            F.substring(e, 1, 2).isin(*TWO_DIGIT_CODES), F.substring(e, 1, 2)).otherwise(F.substring(e, 1, 3))

        def with_code(c: Column) -> Column:
            trunk = F.when(inter & m.contains("(0)") & (F.substr(e, F.length(c) + 1, F.lit(1)) == "0"), F.lit("0")).otherwise(F.lit(""))
            kept = F.when(inter, F.concat(F.when(zeros, F.lit("00")).otherwise(F.lit("")), c, trunk)).when(
                m.rlike(r"^1[ .\-(]"), F.lit("1")).otherwise(F.lit(""))

            def with_kept(k: Column) -> Column:
                national = F.substr(d, F.length(k) + 1, F.length(d))
                return F.when((F.length(national) >= 4) & (F.length(c) + F.length(national)).between(7, 15),
                              _refill(m, F.concat(k, _permute_digits(national, F.concat(F.lit("phone"), c), key))))

            return _let(kept, with_kept)

        return _let(code, with_code)

    return _let(_digits_of(m), body)


def _mod97(s: Column) -> Column:
    """Remainder by 97 of a text of digits and capital letters, these as 10 to 35."""
    return F.aggregate(F.split(s, ""), F.lit(0).cast("long"), lambda acc, c: F.when(c == "", acc).when(c.between("0", "9"), (acc * 10 + F.ascii(c) - 48) % 97)
                       .otherwise((acc * 100 + F.ascii(c) - 55) % 97))


def _iban(m: Column, key: str) -> Column:
    """Country, layout and the places of letters and digits stay; the check digits are right. Null if the number fails the mod 97 test."""
    def body(n: Column) -> Column:
        country, account = F.substring(n, 1, 2), F.substr(n, F.lit(5), F.length(n))
        letters, digits = F.lower(F.regexp_replace(account, "[^A-Z]", "")), _digits_of(account)
        tweak = F.concat(F.lit("iban"), country, F.regexp_replace(F.regexp_replace(account, "[A-Z]", "A"), "[0-9]", "0"))
        moved = _let(F.struct(_in_blocks(digits, 18, _permute_digits, tweak, key).alias("d"), _in_blocks(letters, 12, _permute_letters, tweak, key).alias("l")),
                     lambda new: _refill(account, new["d"], new["l"]))

        def checked(a: Column) -> Column:
            check = F.lpad((98 - _mod97(F.concat(a, country, F.lit("00")))).cast("string"), 2, "0")
            digits = F.concat(check, _digits_of(a))
            return F.concat(country, _refill(F.substr(m, F.lit(3), F.length(m)), digits, F.lower(F.regexp_replace(a, "[^A-Z]", ""))))

        return F.when(F.length(n).between(15, 34) & (_mod97(F.concat(account, F.substring(n, 1, 4))) == 1), _let(moved, checked))

    return _let(F.replace(m, F.lit(" "), F.lit("")), body)


def _ssn(m: Column, key: str) -> Column:
    """Area 001-899 but 666, group 01-99 and serial 0001-9999 are numbered through and permuted."""
    area, group, serial = (F.substring(m, a, n).cast("long") for a, n in ((1, 3), (5, 2), (8, 4)))
    rank = area - 1 - (area > 666).cast("long")
    pair = _feistel(rank * 99 + group - 1, serial - 1, F.lit(898 * 99), F.lit(9999), F.lit("ssn"), key)
    return _let(pair, lambda p: _let(F.floor(p["high"] / 99), lambda a: F.concat_ws(
        "-", F.lpad((a + 1 + (a >= 665).cast("long")).cast("string"), 3, "0"), F.lpad((p["high"] % 99 + 1).cast("string"), 2, "0"),
        F.lpad((p["low"] + 1).cast("string"), 4, "0"))))


def _ipv4(m: Column, key: str) -> Column:
    octet = lambda k: F.split(m, r"\.")[k].cast("long")
    pair = _feistel(octet(0) * 256 + octet(1), octet(2) * 256 + octet(3), F.lit(65536), F.lit(65536), F.lit("ipv4"), key)
    return _let(pair, lambda p: F.concat_ws(".", *(x.cast("string") for x in (
        F.floor(p["high"] / 256), p["high"] % 256, F.floor(p["low"] / 256), p["low"] % 256))))


def _month_start(month: Column) -> Column:
    """Days from FIRST_DAY to the first of a month, by its number from there."""
    return F.datediff(F.add_months(F.lit(FIRST_DAY).cast("date"), month.cast("int")), F.lit(FIRST_DAY).cast("date")).cast("long")


def _permute_day(day: Column, key: str) -> Column:
    """Another day of 1700 to 2099; days up to EARLY_DAYS of their month, and later ones, are permuted among themselves."""
    month = ((F.year(day) - 1700) * 12 + F.month(day) - 1).cast("long")

    def feistel(rank: Column, sizes: tuple[int, int], tweak: str) -> Column:
        pair = _feistel(F.floor(rank / sizes[1]), rank % sizes[1], F.lit(sizes[0]), F.lit(sizes[1]), F.lit(tweak), key)
        return _let(pair, lambda p: p["high"] * sizes[1] + p["low"])

    def early(r: Column) -> Column:
        return F.date_add(F.lit(FIRST_DAY).cast("date"), (_month_start(F.floor(r / EARLY_DAYS)) + r % EARLY_DAYS).cast("int"))

    def late(r: Column) -> Column:
        # Months before number k have _month_start(k) - 12 k later days; the month is the last one that leaves r of them or fewer.
        before = lambda k: _month_start(k) - EARLY_DAYS * k
        guess = F.floor(r * 4800 / (LATE_SIZES[0] * LATE_SIZES[1]))
        near = F.filter(F.sequence(F.greatest(guess - 3, F.lit(0).cast("long")), guess + 3), lambda k: before(k) <= r)
        return _let(F.array_max(near), lambda k: F.date_add(F.lit(FIRST_DAY).cast("date"), (_month_start(k) + EARLY_DAYS + r - before(k)).cast("int")))

    n = F.datediff(day, F.lit(FIRST_DAY).cast("date")).cast("long")
    return F.when(F.dayofmonth(day) <= EARLY_DAYS, _let(feistel(month * EARLY_DAYS + F.dayofmonth(day) - 1, EARLY_SIZES, "early day"), early)).otherwise(
        _let(feistel(n - EARLY_DAYS * (month + 1), LATE_SIZES, "late day"), late))


def _date(m: Column, key: str) -> Column:
    """A day of 1700 to 2099 in the same notation (year first; day first, else month first). Null if there is no such day."""
    slashed = F.regexp_replace(m, r"[.\-]", "/")
    year_first = m.rlike(r"^\d{4}")
    day_first = F.try_to_date(slashed, "d/M/y")

    def body(day: Column) -> Column:
        padded = (F.length(m) == 10) | m.rlike(r"^0|[./\-]0")
        shape = F.when(padded, F.when(day_first.isNotNull(), F.lit("dd/MM/yyyy")).otherwise(F.lit("MM/dd/yyyy"))).otherwise(
            F.when(day_first.isNotNull(), F.lit("d/M/yyyy")).otherwise(F.lit("M/d/yyyy")))

        def written_out(new: Column) -> Column:
            us = F.when(shape == "dd/MM/yyyy", F.date_format(new, "dd/MM/yyyy")).when(shape == "MM/dd/yyyy", F.date_format(new, "MM/dd/yyyy")).when(
                shape == "d/M/yyyy", F.date_format(new, "d/M/yyyy")).otherwise(F.date_format(new, "M/d/yyyy"))
            own = F.when(year_first, F.date_format(new, "yyyy/MM/dd")).otherwise(us)
            return F.when(m.contains("."), F.translate(own, "/", ".")).when(m.contains("-"), F.translate(own, "/", "-")).otherwise(own)

        return F.when(day.isNotNull(), _let(_permute_day(day, key), written_out))

    return _let(F.when(year_first, F.try_to_date(slashed, "yyyy/MM/dd")).otherwise(F.coalesce(day_first, F.try_to_date(slashed, "M/d/y"))), body)


def _email(m: Column, key: str) -> Column:
    """Letters and digits of the local part are permuted among themselves; its other characters and the domain stay."""
    local, domain = F.substring_index(m, "@", 1), F.lower(F.substring_index(m, "@", -1))
    letters, digits = F.lower(F.regexp_replace(local, "[^A-Za-z]", "")), _digits_of(local)
    tweak = F.concat(F.lit("email@"), domain)
    return F.concat(_let(F.struct(
        _in_blocks(digits, 18, _permute_digits, tweak, key).alias("d"), _in_blocks(letters, 12, _permute_letters, tweak, key).alias("l")),
        lambda new: _refill(local, new["d"], new["l"])), F.lit("@"), F.substring_index(m, "@", -1))


PSEUDONYM = {"email": _email, "iban": _iban, "ipv4": _ipv4, "date": _date, "ssn": _ssn, "phone": _phone, "card": _card}


def pattern(kinds: tuple[str, ...] | None = None) -> str:
    """One pattern for the kinds, in the order of KINDS."""
    return "|".join(f"(?:{KINDS[k]})" for k in KINDS if kinds is None or k in kinds)


def pseudonym(match: Column, key: str, kinds: tuple[str, ...] | None = None) -> Column:
    """The pseudonym of one match: of the first kind whose pattern it meets in full and whose test it passes; null without."""
    found = [F.when(match.rlike(f"^(?:{KINDS[k]})$"), PSEUDONYM[k](match, key)) for k in KINDS if kinds is None or k in kinds]
    return F.coalesce(*found)


def pseudonymize(docs: DataFrame, key: str, text_col: str = "text", kinds: tuple[str, ...] | None = None) -> DataFrame:
    """``docs`` with the personal data of its text replaced, and ``n_pseudonyms``, the number of replaced values.

    All other columns stay as they are (one named n_pseudonyms is replaced). A null text stays null, with 0 pseudonyms. What looks like a
    number of some kind but fails its test stays as it is.
    """
    own = F.col(f"`{text_col}`").cast("string")
    found = F.when(own.rlike("[0-9@]"), F.regexp_extract_all(own, F.lit(pattern(kinds)), F.lit(0))).otherwise(F.array().cast("array<string>"))
    kept = [c for c in docs.columns if c != "n_pseudonyms"]
    free = lambda name: name if name not in kept else free("_" + name)
    matches, news = free("_matches"), free("_news")
    step = docs.select(*(F.col(f"`{c}`") for c in kept), found.alias(matches))
    step = step.withColumn(news, F.transform(F.col(matches), lambda m: pseudonym(m, key, kinds)))
    joined = F.array_join(F.flatten(F.zip_with(
        F.split(own, pattern(kinds), -1), F.zip_with(F.col(matches), F.col(news), lambda m, p: F.coalesce(p, m)),
        lambda gap, p: F.array(gap, F.coalesce(p, F.lit(""))))), "")
    text = F.when(F.size(matches) > 0, joined).otherwise(own)
    count = F.coalesce(F.size(F.filter(F.col(news), lambda p: p.isNotNull())), F.lit(0))
    return step.select(*(text.alias(c) if c == text_col else F.col(f"`{c}`") for c in kept), count.alias("n_pseudonyms"))


# Whoever knows the key can undo the pseudonyms: a real job sets KEY_SETTING (from its secret store, and redacts it in spark.redaction.regex).
KEY_SETTING, TEST_KEY = "spark.marketlens.pseudonym.key", "training-data pseudonyms"


def key_of(spark: SparkSession) -> str:
    """The key in the session's settings; the test key where none is set."""
    return spark.conf.get(KEY_SETTING, None) or TEST_KEY


def op6_pii_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts of all documents with pseudonyms for personal data."""
    return pseudonymize(read_table(spark, sf_dir, "documents", "doc_id", "text"), key_of(spark))
