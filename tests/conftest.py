from __future__ import annotations

import json
import os
import sys
import uuid

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

from marketlens.session import build_session, shared_dir  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    s = build_session("local[4]", 4, app_name="marketlens-tests")
    if not s.conf.get("spark.checkpoint.dir", None) and s.sparkContext.getCheckpointDir() is None:
        d = str(tmp_path_factory.mktemp("ckpt"))
        s.sparkContext.setCheckpointDir(d)
        s.conf.set("spark.checkpoint.dir", d)
    shared_dir(s)
    yield s
    s.stop()


@pytest.fixture
def landed(spark, tmp_path):
    """Write records as JSON (one document per line) under a fresh folder and read them back typed."""
    from marketlens.sources.landed import read_landed

    def _landed(records, schema, multi_line=False):
        d = tmp_path / f"landed-{uuid.uuid4().hex[:8]}"
        d.mkdir()
        if multi_line:
            for i, r in enumerate(records):
                (d / f"part-{i}.json").write_text(json.dumps(r, ensure_ascii=False, indent=2), encoding="utf-8")
        else:
            (d / "part-0.json").write_text("\n".join(json.dumps(r, ensure_ascii=False) for r in records),
                                           encoding="utf-8")
        return read_landed(spark, str(d), schema, multi_line=multi_line)

    return _landed


def rows(df, *cols):
    """Collected rows as plain tuples, sorted (order-insensitive comparisons)."""
    sel = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in sel.collect()), key=lambda t: tuple((x is None, str(x)) for x in t))
