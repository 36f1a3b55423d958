"""Order, reuse, gates and observed checks of stored relations."""

import pytest
from pyspark.sql import functions as F

from letterlake.catalog import inputs, queries
from letterlake.operators import quality
from letterlake.plans import graph, semantic
from letterlake.plans.graph import Relation, Source
from letterlake.sinks.commits import TableLog

from .conftest import SMALL


def doubled(rows):
    return rows.select((F.col("n") * 2).alias("n"))


def joined(left, right):
    return left.join(right, "n")


RELATIONS = (
    Relation("end", 2, ("low", "high"), joined),
    Relation("high", 1, ("low", "b"), joined),
    Relation("low", 1, ("a",), doubled),
    Relation("aside", 1, ("b",), doubled),
)


def numbered(spark, *numbers, version="1"):
    return Source(lambda: spark.createDataFrame([(n,) for n in numbers], "n int"), version)


def test_order():
    names = [r.name for r in graph.in_order(RELATIONS, ("a", "b"))]
    assert sorted(names) == sorted(r.name for r in RELATIONS) and names[-1] == "end"
    assert names.index("low") < names.index("high")
    assert [r.name for r in graph.in_order(RELATIONS, ("a", "b"), ["high"])] == ["low", "high"]
    with pytest.raises(KeyError, match="aside reads b"):
        graph.in_order(RELATIONS, ("a",), ["aside"])
    with pytest.raises(ValueError, match="cycle|Cycle"):
        graph.in_order((Relation("x", 0, ("y",), doubled), Relation("y", 0, ("x",), doubled)), ())
    with pytest.raises(ValueError, match="layer above"):
        graph.in_order((Relation("x", 0, ("y",), doubled), Relation("y", 1, (), doubled)), ())


def test_only_what_is_outdated_is_built(spark, folder):
    log, ran = TableLog(spark, folder), []
    traced = [
        Relation(r.name, r.layer, r.inputs, lambda *given, r=r: (ran.append(r.name), r.build(*given))[1]) for r in RELATIONS
    ]

    def build(a, b, **options):
        ran.clear()
        snapshot = graph.build(log, traced, {"a": a, "b": b}, {}, **options)
        return {r.n for r in graph.stored(log, snapshot, "end").collect()} if snapshot.sets("end") else None

    one, two = numbered(spark, 1, 2, 3), numbered(spark, 2, 4, 5)
    assert build(one, two, wanted=["low"]) is None and ran == ["low"]
    assert build(one, two) == {2, 4} and ran[-1] == "end" and "low" not in ran and len(ran) == 3
    assert build(one, two) == {2, 4} and ran == []
    # A new version of b leaves what a alone gives.
    assert build(one, numbered(spark, 4, version="2")) == {4} and sorted(ran) == ["aside", "end", "high"]


def jobs_of(spark, name, action):
    spark.sparkContext.setJobGroup(name, name)
    try:
        result = action()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return result, len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))


def test_the_whole_layer_is_built_once(spark, folder):
    events = inputs.landing_events(spark, SMALL)
    sources = queries._sources(spark, SMALL)

    def build():
        return semantic.build_semantic_layer(spark, events, folder, more=sources)

    built, first = jobs_of(spark, "first", build)
    assert set(built) == set(semantic.MARTS) and len(built) == 10 and first > 0
    again, second = jobs_of(spark, "second", build)
    assert second == 0 and set(again) == set(built)
    # Every check as if it were run on the stored relation.
    log = TableLog(spark, folder)
    report = {tuple(r) for r in graph.check_report(spark, log.snapshot(), semantic.CHECKS).collect()}
    stored = {**semantic.stored_layer(spark, folder), "landing_events": events}
    expected = {
        tuple(r) for name, checks in semantic.CHECKS.items() for r in quality.run_checks(stored[name], name, checks).collect()
    }
    assert report == expected
    fresh = graph.freshness_report(spark, log.snapshot(), quality.FRESHNESS, queries.FRESHNESS_TIME)
    for name, rule in quality.FRESHNESS.items():
        assert fresh.where(F.col("relation") == name).collect() == quality.freshness(stored[name], name, rule, queries.FRESHNESS_TIME).collect()


def test_a_report_builds_what_it_tells_of(spark, monkeypatch):
    """The same rows whether a report comes first or after others, and no relation for nothing."""
    reports = [*quality.ROW_CHECKS, "unique", "unique_combination"]
    whole = {name: {tuple(r) for r in queries._check(spark, SMALL, name).collect()} for name in reports}
    built = {}
    for name in reports:
        monkeypatch.setattr(queries, "_LAYERS", {})
        found = semantic.checked(name)
        snapshot = queries._checked(spark, SMALL, found)
        assert {tuple(r) for r in graph.check_report(spark, snapshot, found, name).collect()} == whole[name]
        assert {r[1] for r in whole[name]} == set(found)
        built[name] = set(snapshot.tables)
    assert "fct_mail_lifecycle" not in built["non_negative"] and "fct_mail_lifecycle" in built["unique"]
    assert "template_performance" not in built["unique"]
    monkeypatch.setattr(queries, "_LAYERS", {})
    fresh = set(queries._checked(spark, SMALL, quality.FRESHNESS).tables)
    assert fresh == {"activity_rollup", "dim_customer_tenant", "dim_customer_event_type", "fct_daily_customer_delivery"}


def test_row_checks_cost_no_scan(spark, folder):
    """They are counted on the way to the files: what was stored is not asked."""
    suite = {"low": quality.Checks(not_null=("n",), non_negative=("n",))}
    rows = spark.createDataFrame([(-1,), (None,), (3,)], "n int")
    observed = graph._Observed("low", rows, suite, {})
    TableLog(spark, folder).write(observed.rows.groupBy("n").count(), "low")
    notes = observed.notes(stored=None)
    assert '["not_null", "n", 1], ["non_negative", "n", 1]' in notes["checks/low"]


def test_a_landing_scan_serves_rollup_and_checks(spark, folder):
    reads = []
    events = inputs.landing_events(spark, SMALL)
    source = Source(lambda: (reads.append(1), events)[1], "1")
    log = TableLog(spark, folder)
    snapshot = graph.build(log, semantic.RELATIONS, {"landing_events": source}, semantic.CHECKS, wanted=["event_type"])
    assert reads == [1]
    report = graph.check_report(spark, snapshot, ["landing_events"]).collect()
    assert {(r.check, r.column): r.failures for r in report}[("not_null", "tenant_id")] == events.where("tenant_id is null").count() > 0


def test_checks_of_empty_relations(spark, folder):
    suite = {"low": quality.Checks(not_null=("n",), unique=("n",), unique_combination=(("n",),))}
    snapshot = graph.build(TableLog(spark, folder), RELATIONS, {"a": numbered(spark)}, suite, wanted=["low"], gate=True)
    report = graph.check_report(spark, snapshot, ["low"]).collect()
    assert len(report) == 3 and {r.failures for r in report} == {0}


def test_a_gate_between_layers(spark, folder):
    log = TableLog(spark, folder)
    suite = {"high": quality.Checks(unique=("n",)), "b": quality.Checks(non_negative=("n",))}
    sources = {"a": numbered(spark, 1, 2), "b": numbered(spark, 2, 2, 4, -1)}
    with pytest.raises(quality.QualityError, match="b.n non_negative: 1; high.n unique: 1"):
        graph.build(log, RELATIONS, sources, suite, gate=True)
    assert not log.snapshot().sets("end") and log.snapshot().sets("high")
    # Built again without a change, it stops at the noted results; with better rows it goes on.
    with pytest.raises(quality.QualityError):
        graph.build(log, RELATIONS, sources, suite, gate=True)
    better = {"a": sources["a"], "b": numbered(spark, 2, 4, version="2")}
    assert graph.build(log, RELATIONS, better, suite, gate=True).sets("end")
