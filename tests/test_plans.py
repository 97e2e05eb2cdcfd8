"""Plans have the shape that scale needs."""

import re

import pytest
from tables import DATA

from tidemark.plans import registry

SF = str(DATA / "sf0.001")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(("name", "columns"), [("source_counts", {"event_type"}), ("word_counts", {"doc_id", "text"}), ("sha256_docs", {"doc_id", "text"}), ("corpus_gate", {"p_partkey", "p_name", "p_size"})])
def test_scans_read_only_what_is_used(spark, name, columns):
    read = re.findall(r"ReadSchema: struct<([^>]*)>", plan(registry.QUERIES[name](spark, SF)))
    assert read and all({c.split(":")[0] for c in r.split(",")} <= columns for r in read)


@pytest.mark.parametrize("name", ["video_id_extract", "html_anchors", "html_cells", "stamp_dmy", "iso_day", "clean_text", "reflow", "page_furniture_in_row", "cluster_by_table"])
def test_row_functions_do_not_shuffle(spark, name):
    shown = plan(registry.QUERIES[name](spark, SF))
    assert "Cartesian" not in shown and "Python" not in shown and "ArrowEval" not in shown
    if name != "cluster_by_table":
        assert "Exchange" not in shown


def test_filters_reach_the_scan(spark):
    shown = plan(registry.QUERIES["lookup_lines"](spark, SF).filter("video_id = '1'"))
    assert "Exchange" not in shown
    cut = plan(spark.read.parquet(f"{SF}/events.parquet").filter("user_id = 3").select("event_id"))
    assert "PushedFilters: [IsNotNull(user_id), EqualTo(user_id,3)]" in cut


def test_no_window_over_all_rows(spark):
    """Places in a global order come from ranges; the only row numbers are of a channel's titles and a domain's first members."""
    for name in ("history_union_order", "fetch_shards", "rank_creators", "cluster_members", "ordinal_within"):
        shown = plan(registry.QUERIES[name](spark, SF))
        for line in shown.splitlines():
            if re.search(r"Window \[row_number", line):
                assert "channel" in line, line
        assert "SinglePartition" not in shown or "__range" in shown
