"""Per-row transforms of docs, chained and chosen by name.

A step is a function ``docs -> docs``; its arguments are keyword arguments.
Steps only add column expressions, so a chain stays one pass over the table. A
step that may fail for a row uses try-expressions and says in ``FAILURES`` when it
did: such rows leave the chain as rejects, and the job goes on.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliant.functions.spans import annotation_set, canonical_name, match_spans, set_annotation_set
from foliant.functions.text import is_blank, trimmed
from foliant.model import META_TYPE, SRC_FIELDS, TEXT_FIELDS
from foliant.operators.rows import computed, long_result
from foliant.operators.scan import text_status

Step = Callable[..., DataFrame]
STEPS: dict[str, Step] = {}


def step(name: str) -> Callable[[Step], Step]:
    """Make a step known under a name."""

    def register(function: Step) -> Step:
        if STEPS.get(name, function) is not function:
            raise ValueError(f"step {name} exists")
        STEPS[name] = function
        return function

    return register


def run(docs: DataFrame, name: str, families: Sequence[str] | None = None, **arguments) -> DataFrame:
    """One step by name, over chosen families only."""
    if name not in STEPS:
        raise KeyError(f"no step {name}; known: {sorted(STEPS)}")
    table = docs if families is None else docs.select("row_key", *families)
    return table.transform(STEPS[name], **arguments)


def chain(docs: DataFrame, *jobs: str | tuple[str, dict]) -> DataFrame:
    """Steps in order; each sees what the ones before it added."""
    for job in jobs:
        name, arguments = (job, {}) if isinstance(job, str) else job
        docs = run(docs, name, **arguments)
    return docs


def row_bytes() -> Column:
    """S14 for docs: bytes of all values that the row stores."""
    fields = [F.col("src")[f] for f in SRC_FIELDS] + [F.col("text")[f] for f in TEXT_FIELDS if f != "reference"]
    values = F.array(*fields, F.array_join(F.col("text.reference"), ";"), F.to_json("annotations"))
    every = F.concat(values, F.coalesce(F.map_values("meta"), F.array().cast("array<string>")))
    return F.aggregate(every, F.lit(0).cast("bigint"), lambda sum, v: sum + F.coalesce(F.octet_length(v), F.lit(0)))


def guard(max_chars: int | None, max_bytes: int | None) -> Column:
    """``kept``, or why a row does not enter a chain."""
    reason = F.lit("kept")
    if max_chars is not None:
        reason = text_status(max_chars)
    if max_bytes is not None:
        reason = F.when(row_bytes() > max_bytes, f"skip -- row too large ({max_bytes})").otherwise(reason)
    return reason


FAILED = "struct<step:string,reason:string>"


def _flagged_chain(docs: DataFrame, jobs, max_chars: int | None, max_bytes: int | None) -> tuple[DataFrame, DataFrame, dict[str, str]]:
    """Rows with their status; those that enter the chain after its steps, with
    ``__failed`` and a flag per step; the flags by the steps' names.

    A row that a step fails for goes through the rest, where every step is total,
    so that one pass makes results and rejects; what later steps do to it is not seen.
    """
    rows = computed(docs, "__status", guard(max_chars, max_bytes))
    kept = rows.where("__status = 'kept'").withColumn("__failed", F.lit(None).cast(FAILED))
    flags = {}
    for number, job in enumerate(jobs, 1):
        name, arguments = (job, {}) if isinstance(job, str) else job
        label, flag = f"{number} {name}", f"__added{number}"
        flags[label] = flag
        if name in FAILURES:
            reason = FAILURES[name](**arguments)
            found = F.when(reason.isNotNull(), F.struct(F.lit(label).alias("step"), reason.alias("reason")))
            kept = kept.withColumn("__failed", F.coalesce("__failed", found))
        if name in ADDS_BEFORE:
            kept = kept.withColumn(flag, F.col("__failed").isNull() & ADDS_BEFORE[name](**arguments))
        kept = run(kept, name, **arguments)
        if name in ADDS_AFTER:
            kept = kept.withColumn(flag, F.col("__failed").isNull() & ADDS_AFTER[name](**arguments))
    return rows, kept, flags


def tried_chain(
    docs: DataFrame, *jobs: str | tuple[str, dict], max_chars: int | None = None, max_bytes: int | None = None
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """U2 with its error channel: results, rejects (row_key, step, reason), counters.

    A row leaves at the guard that keeps it out (step ``guard``) or at the first step
    that fails for it; every other row is a result. Results and rejects together are
    the input. The counters are those of ``counted_chain``, of rows that completed,
    and ``row process error`` by step.
    """
    rows, kept, flags = _flagged_chain(docs, jobs, max_chars, max_bytes)
    status, skipped = F.col("__status"), rows.where("__status <> 'kept'")
    rejects = skipped.select("row_key", F.lit("guard").alias("step"), status.alias("reason"))
    rejects = rejects.unionByName(kept.where("__failed is not null").select("row_key", "__failed.step", "__failed.reason"))
    return kept.where("__failed is null").drop("__status", "__failed", *flags.values()), rejects, _chain_counts(rows, kept, flags)


def counted_chain(
    docs: DataFrame, *jobs: str | tuple[str, dict], max_chars: int | None = None, max_bytes: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """U2 with its counters: the documents that pass the guards after all steps,
    and (counter_group, counter, n) of rows started, skipped by reason, completed,
    and per step the rows to which it added something.

    The flags are columns of the same pass; the counters are one aggregate over
    them. Rows for which a step fails are left out and counted (see ``tried_chain``).
    """
    results, _, counts = tried_chain(docs, *jobs, max_chars=max_chars, max_bytes=max_bytes)
    return results, counts


def _chain_counts(rows: DataFrame, kept: DataFrame, flags: dict[str, str]) -> DataFrame:
    failed = {name: F.coalesce(F.col("__failed.step") == name, F.lit(False)) for name in flags if name.partition(" ")[2] in FAILURES}
    errors = {name: f"__failed{number}" for number, name in enumerate(failed)}
    added = [F.count_if(F.col("__failed").isNull() & F.col(f)).alias(f) for f in flags.values()]
    sums = kept.agg(F.count_if(F.col("__failed").isNull()).alias("n"), *added, *[F.count_if(failed[k]).alias(c) for k, c in errors.items()])
    entries = [F.struct(F.lit("rows").alias("g"), F.lit("completed").alias("c"), F.col("n").alias("n"))]
    entries += [F.struct(F.lit("added").alias("g"), F.lit(name).alias("c"), F.col(f).alias("n")) for name, f in flags.items()]
    entries += [F.struct(F.lit("row process error").alias("g"), F.lit(name).alias("c"), F.col(c).alias("n")) for name, c in errors.items()]
    done = sums.select(F.inline(F.array(*entries)))
    status = rows.groupBy("__status").agg(F.count("*").alias("n"))
    entered = status.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).select(*long_result("rows", "started", F.col("n")))
    skipped = status.where("__status <> 'kept'").select(*long_result("rows", F.col("__status"), F.col("n")))
    return entered.unionByName(skipped).unionByName(done.select(*long_result(F.col("g"), F.col("c"), F.col("n"))))


def field_value(field: str) -> Column:
    """the value of ``field`` or ``family:field``; no family means meta."""
    family, colon, name = field.partition(":")
    if not colon:
        family, name = "meta", field
    if family == "annotations":
        return F.to_json(F.col("annotations")[name])
    if family == "text" and name == "reference":
        return F.array_join(F.col("text.reference"), ";")
    return F.col(family)[name]


def put_metadata(meta: Column, key: str, value: Column) -> Column:
    """One key; the new value wins. A null or blank value changes nothing."""
    held = F.coalesce(meta, F.create_map().cast(META_TYPE))
    put = F.map_concat(F.map_filter(held, lambda k, _: k != key), F.create_map(F.lit(key), value))
    return F.when(is_blank(value), held).otherwise(put)


def merge_metadata(meta: Column, values: Column) -> Column:
    """A map of values; new ones win."""
    held = F.coalesce(meta, F.create_map().cast(META_TYPE))
    added = F.coalesce(values, F.create_map().cast(META_TYPE))
    rest = F.map_filter(held, lambda k, _: ~F.map_contains_key(added, k))
    return F.map_concat(rest, added)


def add_field(docs: DataFrame, field: str, value: Column) -> DataFrame:
    """U4: set a field of the row unless the value is blank."""
    family, colon, name = field.partition(":")
    if not colon:
        family, name = "meta", field
    if family == "meta":
        return docs.withColumn("meta", put_metadata(F.col("meta"), name, value))
    known = {"src": SRC_FIELDS, "text": TEXT_FIELDS}.get(family, ())
    if name not in known or name == "reference":
        raise ValueError(f"cannot set {field}")
    kept = F.when(is_blank(value), F.col(family)[name]).otherwise(value)
    return docs.withColumn(family, F.col(family).withField(name, kept))


def added_count(docs: DataFrame, value: Column) -> DataFrame:
    """U4: how many rows a field is added to."""
    return docs.agg(F.count_if(~is_blank(value)).alias("n"))


def add_annotations(docs: DataFrame, name: str, spans: Column, names: dict[str, str] | None = None) -> DataFrame:
    """An annotation set under its canonical name.

    Spans are costly, so they are found once however many steps read them.
    """
    canonical = canonical_name(F.lit(name), names or {})
    return computed(docs, "annotations", set_annotation_set(F.col("annotations"), canonical, spans))


def canonical_sets(docs: DataFrame, names: dict[str, str]) -> DataFrame:
    """U6 for stored sets: every set under its canonical name.

    Two sets that meet under one name are joined into one list.
    """
    entries = F.map_entries("annotations")
    keys = F.array_distinct(F.transform(F.map_keys("annotations"), lambda k: canonical_name(k, names)))

    def gathered(key: Column) -> Column:
        mine = F.filter(entries, lambda e: canonical_name(e["key"], names) == key)
        return F.flatten(F.transform(mine, lambda e: e["value"]))

    return docs.withColumn("annotations", F.map_from_arrays(keys, F.transform(keys, gathered)))


def annotation_set_names(annotations: str = "annotations") -> Column:
    """U11."""
    return F.sort_array(F.map_keys(annotations))


def metadata_keys(meta: str = "meta") -> Column:
    """U11."""
    return F.sort_array(F.map_keys(meta))


# -- steps ---------------------------------------------------------------


@step("matches")
def annotate_matches(docs: DataFrame, set: str, pattern: str, type: str | None = None) -> DataFrame:
    """Annotate every match of a pattern in the raw text."""
    return add_annotations(docs, set, match_spans(F.col("text.raw"), pattern, type or set))


@step("title")
def title_from_first_line(docs: DataFrame) -> DataFrame:
    """Set the title to the first line of the raw text."""
    return add_field(docs, "text:title", F.substring_index(F.col("text.raw"), "\n", 1))


@step("copy")
def copy_field(docs: DataFrame, source: str, target: str) -> DataFrame:
    return add_field(docs, target, field_value(source))


@step("count")
def count_annotations(docs: DataFrame, set: str, field: str) -> DataFrame:
    """Store the size of an annotation set, as made by an earlier step."""
    return add_field(docs, field, F.size(annotation_set(set)).cast("string"))


@step("drop")
def drop_annotations(docs: DataFrame, set: str) -> DataFrame:
    from foliant.operators.clean import without_annotation_set

    return without_annotation_set(docs, set)


@step("number")
def number_field(docs: DataFrame, source: str, target: str) -> DataFrame:
    """Store a field that holds a number in one notation; fails for any other text that is not blank."""
    return add_field(docs, target, _number(source).cast("string"))


@step("date")
def date_field(docs: DataFrame, source: str, target: str, format: str = "yyyy-MM-dd") -> DataFrame:
    """Store a field that holds a date as an ISO date; fails for any other text that is not blank."""
    return add_field(docs, target, F.date_format(F.try_to_timestamp(trimmed(field_value(source)), F.lit(format)), "yyyy-MM-dd"))


def _number(source: str) -> Column:
    return trimmed(field_value(source)).try_cast("decimal(38,6)")


def _unread(kind: str, source: str, value: Column) -> Column:
    """Why a field that is not blank has no value; null if it has."""
    text = field_value(source)
    return F.when(~is_blank(text) & value.isNull(), F.concat(F.lit(f"no {kind} in {source}: "), F.substring(text, 1, 40)))


# Why a step fails for a row, null if it does not. A step that is not listed fails for none: its
# expressions are total.
FAILURES: dict[str, Callable[..., Column]] = {
    "number": lambda source, target: _unread("number", source, _number(source)),
    "date": lambda source, target, format="yyyy-MM-dd": _unread(
        "date", source, F.try_to_timestamp(trimmed(field_value(source)), F.lit(format))
    ),
}
# Whether a step adds something to a row: seen before it runs, or after.
ADDS_BEFORE: dict[str, Callable[..., Column]] = {
    "title": lambda: ~is_blank(F.substring_index(F.col("text.raw"), "\n", 1)),
    "copy": lambda source, target: ~is_blank(field_value(source)),
    "count": lambda set, field: F.lit(True),
    "number": lambda source, target: _number(source).isNotNull(),
    "date": lambda source, target, format="yyyy-MM-dd": ~is_blank(field_value(source)),
    "drop": lambda set: F.map_contains_key(F.col("annotations"), F.lit(set)),
}
ADDS_AFTER: dict[str, Callable[..., Column]] = {
    "matches": lambda set, pattern, type=None: F.size(annotation_set(set)) > 0,
}
