"""Registered queries against their SQL counterparts, and their contracts where SQL has none."""

from __future__ import annotations

import zlib
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as registry
from telemetry_lake.llm.queries import ORACLES, QUERIES

from .conftest import SF_DIR

pytestmark = pytest.mark.skipif(not Path(SF_DIR).is_dir(), reason="test tables are not there")


def test_one_query_per_operator():
    assert [name.split("_")[0] for name in sorted(QUERIES, key=lambda n: int(n[2:].split("_")[0]))] == [f"op{n}" for n in range(1, 14)]
    assert {*QUERIES, "pipeline"} <= set(registry.queries())
    assert set(ORACLES) <= set(registry.oracle_sql())


@pytest.mark.parametrize("name", ORACLES)
def test_query_matches_sql(spark, name):
    duck = duckdb.connect()
    for file in Path(SF_DIR).glob("*.parquet"):
        duck.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    ours = QUERIES[name](spark, SF_DIR)
    theirs = duck.execute(ORACLES[name])
    columns = sorted(c[0] for c in theirs.description)
    assert sorted(ours.columns) == columns
    place = {c[0]: k for k, c in enumerate(theirs.description)}
    expected = sorted((tuple(row[place[c]] for c in columns) for row in theirs.fetchall()), key=repr)
    assert sorted((tuple(row) for row in ours.select(*columns).collect()), key=repr) == expected


def test_toxicity_on_held_out_rows(spark):
    """Learnt at sf0.01, where there are enough labelled rows, and judged on the fifth kept apart."""
    sf_dir = SF_DIR.replace("sf0.001", "sf0.01")
    scored = {row.doc_id: row for row in QUERIES["op1_toxicity"](spark, sf_dir).collect()}
    labels = {row.doc_id: row.toxic for row in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    held = [i for i in labels if zlib.crc32(str(i).encode()) % 5 == 0]
    assert all(scored[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i in scored)
    assert all(0 <= row.score <= 1 and row.predicted == (row.score >= 0.5) for row in scored.values())
    assert sum(scored[i].predicted == labels[i] for i in held) >= 0.97 * len(held)
    assert sum(scored[i].predicted for i in held if labels[i]) >= 0.8 * sum(labels[i] for i in held)


def test_pages(spark):
    """Against the article elements, read by another way."""
    import html
    import re

    sources = {row.page_id: row.html for row in spark.read.parquet(f"{SF_DIR}/pages.parquet").collect()}
    rows = QUERIES["op7_html_extraction"](spark, SF_DIR).collect()
    assert len(rows) == len(sources)
    for row in rows:
        inner = re.search(r"<article>(.*)</article>", sources[row.page_id], re.S)[1]
        text = html.unescape(re.sub(r"<[^>]*>", " ", re.sub(r"</?b>", "", inner)))
        assert row.text == " ".join(text.split())
        assert row.n_chars == len(row.text)
