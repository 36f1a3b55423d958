"""Stored relations that declare their inputs: built in order, only where outdated, gated by layers.

A relation is computed from stored relations and sources, written as a table of the root's commit log, and
noted with what it was computed from: the version of every source and of every relation below it. A build
leaves a relation alone whose inputs are the ones noted, so a second build runs no job.

Checks of single rows are counted while the relation is written, by an observation on the rows on their
way to the files; those of a source, while the first relation that reads it is written. Only keys need a
pass of their own, over the stored key columns. The counts are kept with the commit that made the
relation visible; the gate and every report read them from there.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass
from graphlib import TopologicalSorter

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from letterlake.operators import quality
from letterlake.sinks.commits import Change, Snapshot, TableLog

REPORT = T.StructType(
    [
        T.StructField("check", T.StringType()),
        T.StructField("relation", T.StringType()),
        T.StructField("column", T.StringType()),
        T.StructField("failures", T.LongType()),
    ]
)


@dataclass(frozen=True)
class Relation:
    """``build`` takes the inputs in their order. Relations of a layer start when the layers below pass."""

    name: str
    layer: int
    inputs: tuple[str, ...]
    build: Callable[..., DataFrame]


@dataclass(frozen=True)
class Source:
    """Rows from outside and the version they have; ``rows`` is called when they are needed."""

    rows: Callable[[], DataFrame]
    version: str


def in_order(relations: Iterable[Relation], sources: Iterable[str], wanted: Iterable[str] | None = None) -> list[Relation]:
    """The wanted relations (all by default) and those they need, inputs before what reads them.

    Layers come one after the other; within them relations keep their declared order where inputs allow.
    """
    by_name = {relation.name: relation for relation in relations}
    needed: dict[str, Relation] = {}

    def need(name: str, reader: str) -> None:
        if name in sources or name in needed:
            return
        if name not in by_name:
            raise KeyError(f"{reader} reads {name}, which is neither a relation nor a source")
        needed[name] = by_name[name]
        for below in by_name[name].inputs:
            need(below, name)

    for name in by_name if wanted is None else wanted:
        need(name, "the build")
    order = list(TopologicalSorter({name: [i for i in relation.inputs if i in needed] for name, relation in needed.items()}).static_order())
    for name in order:
        for below in needed[name].inputs:
            if below in needed and needed[below].layer > needed[name].layer:
                raise ValueError(f"{name} reads {below} of a layer above")
    return sorted((needed[name] for name in order), key=lambda relation: relation.layer)


def _built(name: str) -> str:
    return f"built/{name}"


def _checked(name: str) -> str:
    return f"checks/{name}"


def _schema(name: str) -> str:
    return f"schema/{name}"


def stored(log: TableLog, snapshot: Snapshot, name: str) -> DataFrame:
    """A relation as it was last built. Its schema is noted, so no file is opened to plan a read."""
    return log.read(snapshot, name, T.StructType.fromJson(json.loads(snapshot.notes[_schema(name)])))


def _version(snapshot: Snapshot, sources: Mapping[str, Source], name: str) -> str:
    return f"source {sources[name].version}" if name in sources else snapshot.notes.get(_built(name), "")


def _inputs(snapshot: Snapshot, sources: Mapping[str, Source], relation: Relation) -> str:
    versions = [relation.name, *(f"{name}={_version(snapshot, sources, name)}" for name in relation.inputs)]
    return hashlib.sha256(json.dumps(versions).encode()).hexdigest()


class _Observed:
    """Counts failing rows, and finds the newest one, while ``rows`` are used for something else."""

    def __init__(self, name: str, rows: DataFrame, suite: Mapping[str, quality.Checks], fresh: Mapping[str, quality.Freshness]):
        checks = suite.get(name, quality.Checks())
        self.name, self.checks = name, checks
        self.per_row = [(check, column) for check in quality.ROW_CHECKS for column in getattr(checks, check)]
        self.counts: list[Column] = [
            F.coalesce(F.count_if(quality.ROW_CHECKS[check](column)), F.lit(0)).alias(f"n{at}") for at, (check, column) in enumerate(self.per_row)
        ]
        if name in fresh:
            self.counts.append(F.max(F.col(fresh[name].loaded_at).cast("timestamp_ntz")).cast("string").alias("newest"))
        self.observation = Observation()
        self.rows = rows.observe(self.observation, *self.counts) if self.counts else rows

    def notes(self, stored: DataFrame) -> dict[str, str]:
        """The results, after the rows were written; keys are looked up among the ``stored`` ones, and nothing else."""
        found = {}
        if self.counts:
            try:
                found = self.observation.get
            except Py4JJavaError:
                # The plan turned out to be empty before it came to the observation.
                found = stored.agg(*self.counts).first().asDict()
        failures = [[check, column, found[f"n{at}"]] for at, (check, column) in enumerate(self.per_row)]
        for columns in dict.fromkeys([*((c,) for c in self.checks.unique), *self.checks.unique_combination]):
            # One pass per key tells both counts: with and without keys that hold a null.
            kinds = [("unique", False)] if columns in [(c,) for c in self.checks.unique] else []
            kinds += [("unique_combination", True)] if columns in self.checks.unique_combination else []
            whole = ~F.greatest(*[F.col(c).isNull() for c in columns]) if len(columns) > 1 else F.col(columns[0]).isNotNull()
            counted = quality.duplicate_keys(stored.select(*columns), columns, nulls_count=True).agg(F.count_if(whole), F.count("*")).first()
            failures += [[check, ", ".join(columns), counted[int(nulls)]] for check, nulls in kinds]
        return {_checked(self.name): json.dumps({"failures": failures, "newest": found.get("newest")})}


def build(
    log: TableLog,
    relations: Iterable[Relation],
    sources: Mapping[str, Source],
    suite: Mapping[str, quality.Checks],
    *,
    fresh: Mapping[str, quality.Freshness] = quality.FRESHNESS,
    wanted: Iterable[str] | None = None,
    gate: bool = False,
) -> Snapshot:
    """Builds what is outdated and returns the tables as they are then.

    With ``gate`` a layer starts only when no check of the layers below fails; sources are below all.
    """
    snapshot = log.snapshot()
    rows: dict[str, DataFrame] = {}
    watched: dict[str, _Observed] = {}
    passed = None
    done: list[str] = []
    for relation in in_order(relations, sources, wanted):
        if gate and passed is not None and relation.layer != passed:
            require(snapshot, done)
        passed = relation.layer
        inputs = _inputs(snapshot, sources, relation)
        done += [name for name in (*relation.inputs, relation.name) if name not in done]
        if snapshot.notes.get(_built(relation.name)) == inputs:
            continue
        given, seen_first = [], []
        for name in relation.inputs:
            if name not in sources:
                given.append(stored(log, snapshot, name))
                continue
            if name not in rows:
                rows[name] = sources[name].rows()
            noted = f"{_checked(name)}@{sources[name].version}"
            if name in suite and noted not in snapshot.notes and name not in watched:
                watched[name] = _Observed(name, rows[name], suite, fresh)
                seen_first.append(name)
                given.append(watched[name].rows)
            else:
                given.append(rows[name])
        observed = _Observed(relation.name, relation.build(*given), suite, fresh)
        written = log.write(observed.rows, relation.name)
        notes = {_built(relation.name): inputs, _schema(relation.name): observed.rows.schema.json()}
        notes |= observed.notes(stored(log, Snapshot(0, {written.table: {written.name: written.sizes}}, notes), relation.name))
        for name in seen_first:
            notes |= watched[name].notes(rows[name]) | {f"{_checked(name)}@{sources[name].version}": "done"}

        def change(now: Snapshot, relation=relation, written=written, notes=notes) -> Change:
            return Change([written], {relation.name: {one: list(sizes) for one, sizes in now.sets(relation.name).items()}}, {relation.name: None}, notes)

        snapshot = log.transact(change)
    if gate:
        require(snapshot, done)
    return snapshot


def _results(snapshot: Snapshot, names: Iterable[str]) -> dict[str, dict]:
    return {name: json.loads(snapshot.notes[_checked(name)]) for name in names if _checked(name) in snapshot.notes}


def require(snapshot: Snapshot, names: Iterable[str]) -> None:
    """Raises when a check of the relations fails."""
    failed = [
        f"{name}.{column} {check}: {failures}"
        for name, found in _results(snapshot, names).items()
        for check, column, failures in found["failures"]
        if failures
    ]
    if failed:
        raise quality.QualityError("; ".join(sorted(failed)))


def check_report(spark: SparkSession, snapshot: Snapshot, names: Iterable[str], check: str | None = None) -> DataFrame:
    """check, relation, column, failures, as they were counted when the relations were written."""
    rows = [
        (kind, name, column, failures)
        for name, found in _results(snapshot, names).items()
        for kind, column, failures in found["failures"]
        if check in (None, kind)
    ]
    return spark.createDataFrame(rows, REPORT)


def freshness_report(spark: SparkSession, snapshot: Snapshot, rules: Mapping[str, quality.Freshness], now: str) -> DataFrame:
    """The newest row of each relation, as found when it was written, against its allowed age."""
    newest = T.StructType([T.StructField("relation", T.StringType()), T.StructField("newest", T.StringType())])
    found = spark.createDataFrame([(name, result["newest"]) for name, result in _results(snapshot, rules).items()], newest)
    report = None
    for name, rule in rules.items():
        one = found.where(F.col("relation") == name).select(F.col("newest").cast("timestamp_ntz").alias(rule.loaded_at))
        result = quality.freshness(one, name, rule, now)
        report = result if report is None else report.unionByName(result)
    return report
