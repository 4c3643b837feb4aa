"""Work that is done once, however often its result is looked at."""

import contextlib
import io
import re

import pytest

from __spark_entry__ import queries
from broadsheet.operators import signals as G
from broadsheet.plans import catalog
from broadsheet.plans.bindings import Tables
from broadsheet.sources import scans

SF = "/root/testdata/sf0.001"


def explained(df, mode="simple"):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(mode)
    return out.getvalue()


def snapshots(spark, tmp_path):
    folder = tmp_path / "source=NASA"
    folder.mkdir()
    (folder / "a.xml").write_text("<rss><channel><item><title>a &amp; b</title><link>l</link></item><item><title>x</title><b></item><item><b></item></channel></rss>")
    return scans.snapshots(spark, str(tmp_path))


def test_feed_health_parses_items_once(spark, tmp_path):
    """Only the form of whole snapshots is looked at beside the one parse of the items."""
    assert explained(queries()["src4_feed_health"](spark, SF)).count("FileScan binaryFile") == 1
    assert sorted(r["state"] for r in scans.feed_states(snapshots(spark, tmp_path)).collect()) == ["lost", "recovered", "whole"]


def test_markup_is_settled_once_per_snapshot(spark, tmp_path):
    """The pattern of CDATA stands in the plan where the text is cut and where the pieces are taken, and nowhere else."""
    rows = scans.feed_entries(snapshots(spark, tmp_path))
    assert explained(rows).count(r"<!\[CDATA\[(.*?)\]\]>") == 2
    assert [r["title"] for r in rows.orderBy("feed_pos").collect()] == ["a & b", "x"]


def test_sweep_looks_for_signals_once(spark):
    rows = G.payload_rows(Tables(spark, SF).payloads(), G.KEY_FIELDS)
    assert explained(rows).count("$.signals") == 1


def test_signals_read_the_rest_of_kept_entries_only(spark):
    """What a signal says beside its key is read above the dedup."""
    plan = explained(Tables(spark, SF).signals())
    assert plan.index("StructField(relevance") < plan.index("WindowGroupLimit") < plan.index("StructField(subject")


def test_payloads_are_compiled_and_dealt_out(spark):
    """The JVM compiles no method over 8,000 bytes; a table in one file is parsed by all tasks."""
    assert re.search(r"Exchange hashpartitioning\(event_id", explained(Tables(spark, SF).payloads()))
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        code = explained(Tables(spark, SF).payloads(), "codegen")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", code)]
    assert sizes and max(sizes) < 8000


def test_payloads_keep_their_number_of_tasks(spark):
    """Joined by size, events come to about one task a core, and the last of them runs alone."""
    payloads = Tables(spark, SF).payloads()
    payloads.collect()
    assert "REPARTITION_BY_NUM" in explained(payloads)
    assert payloads.rdd.getNumPartitions() >= 4 * spark.sparkContext.defaultParallelism


class Taken(Exception):
    """Ends a query where its first run begins."""


def test_runs_share_one_intake(spark, monkeypatch):
    """Three runs look at the articles of a day several times each; the table of documents is read once."""
    def run(log, articles, *_, **__):
        raise Taken(explained(articles))

    monkeypatch.setattr(catalog, "run_daily", run)
    with pytest.raises(Taken) as taken:
        queries()["snk2_commit"](spark, SF)
    assert "documents.parquet" not in str(taken.value)
