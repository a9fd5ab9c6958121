"""Every registered query against its SQL check, and rules on the plans."""

from pathlib import Path

import pytest

import __spark_entry__ as entry
from starloom.catalog import ALL
from tests.check import compare, connect

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def connection():
    return connect(SF_DIR)


PAIRWISE_OR_PYTHON = ("BatchEvalPython", "ArrowEvalPython", "BroadcastNestedLoopJoin", "CartesianProduct")


@pytest.mark.parametrize("name", sorted(ALL))
def test_query_equals_sql_on_a_native_plan(spark, connection, plan, name):
    df = ALL[name].build(spark, SF_DIR)
    ok, note = compare(ALL[name], df, connection)
    assert ok, note
    text = plan(df)
    assert [node for node in PAIRWISE_OR_PYTHON if node in text] == []


def test_contract(spark):
    assert entry.queries().keys() >= ALL.keys()
    assert entry.oracle_sql().keys() <= entry.queries().keys()
    assert entry.entry(spark).columns == ["vendor", "factor", "factor_count", "rank"]


def test_only_needed_columns_are_read_and_unused_join_is_dropped(spark, plan):
    from starloom.catalog import inputs
    from starloom.plans import music

    text = plan(music.users_dim(inputs.events(spark, SF_DIR)))
    assert "ReadSchema: struct<user_id:bigint,event_type:string,value:double>" in text
    assert "Join" not in text


def test_filter_reaches_the_staged_files(spark, plan, tmp_path):
    from starloom.catalog import inputs
    from starloom.plans import music

    path = str(tmp_path / "staged")
    inputs.events(spark, SF_DIR).write.parquet(path)
    text = plan(music.time_dim(spark.read.parquet(path), plays_only=True))
    assert "EqualTo(page,NextSong)" in text
    assert "ReadSchema: struct<page:string,ts:bigint>" in text


def test_json_text_is_parsed_once(spark, plan):
    from starloom.schemas import STAGING_EVENTS
    from starloom.sources.staging import stage_json_text

    text = spark.createDataFrame([('{"page": "x"}',)], "v string")
    by_name = stage_json_text(text, "v", STAGING_EVENTS)
    by_path = stage_json_text(text, "v", STAGING_EVENTS, {f.name: f"$.{f.name}" for f in STAGING_EVENTS})
    for df in (by_name, by_path):
        lines = plan(df).splitlines()
        assert sum("from_json" in line for line in lines) <= 1
        assert max(line.count("from_json") for line in lines) <= 1
