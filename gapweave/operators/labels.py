"""Fuzzy consolidation of text labels.

Labels are compared only with bounded batches of targets that travel to the executors; each label keeps
its running best target. Nothing is cross-joined and no pair list is ever written."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from gapweave.functions.scalars import clean_text, normalize_label, quoted, token_sorted
from gapweave.functions.similarity import TargetScorer, ratio
from gapweave.operators.joins import lookup_join, map_values
from gapweave.operators.stats import combination_counts, mode_by
from gapweave.session import cut, partitions

# Leaders that travel to the tasks at once.
_LARGEST_BATCH = 4096

_STATE = "id string, text string, n long, leader string, leader_text string, score int, is_leader boolean"


def _resolve_batch(batch: list, cutoff: int, key_first: bool) -> list:
    """Leaders inside one bounded batch, scanned in rank order."""
    leaders: list = []
    scorer = TargetScorer([r["text"] for r in batch], cutoff, key_first)
    taken: set[int] = set()
    for position, found in scorer.matches([r["text"] for r in batch]):
        if not any(t in taken for t, _ in found if t < position):
            taken.add(position)
            leaders.append(batch[position])
    return leaders


def _assign(state: DataFrame, leaders: list, cutoff: int, key_first: bool, best: bool) -> DataFrame:
    """Score every open label against the new leaders; earlier leaders only, best or first match."""
    ranks = [(-r["n"], r["id"]) for r in leaders]
    texts = [r["text"] for r in leaders]
    ids = [r["id"] for r in leaders]
    places = {i: p for p, i in enumerate(ids)}

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = TargetScorer(texts, cutoff, key_first)
        for pdf in frames:
            pdf["score"] = pdf["score"].astype("Int32")
            pdf.loc[pdf["id"].isin(places), "is_leader"] = True
            # Members of the `first` kind are final; leaders never move.
            open_rows = pdf[~pdf["is_leader"] & (pdf["leader"].isna() | best)]
            for (index, n, key, known), (_, found) in zip(
                open_rows[["n", "id", "score"]].itertuples(name=None), scorer.matches(open_rows["text"].tolist())
            ):
                found = [(s, t) for t, s in found if ranks[t] < (-n, key)]
                if not found:
                    continue
                score, t = max(found, key=lambda x: (x[0], -x[1])) if best else found[0]
                if pd.isna(known) or score > known:
                    pdf.at[index, "leader"] = ids[t]
                    pdf.at[index, "leader_text"] = texts[t]
                    pdf.at[index, "score"] = score
            yield pdf

    return state.mapInPandas(run, _STATE)


def leader_groups(labels: DataFrame, cutoff: int = 85, best: bool = True, key_first: bool = True, batch: int = 512) -> DataFrame:
    """Greedy grouping in order of (n desc, id): a label joins an earlier leader that scores at least
    ``cutoff`` (the best one, or the first one), otherwise it leads a group of its own.

    ``labels`` has distinct ``id``, the compared ``text`` and the frequency ``n``. Each round takes the next
    ``batch`` labels without a match, finds the leaders among them, and scores the rest against those."""
    spark = labels.sparkSession
    none = F.lit(None)
    state = cut(
        labels.select(
            F.col("id").cast("string").alias("id"),
            F.col("text").cast("string").alias("text"),
            F.col("n").cast("long").alias("n"),
            none.cast("string").alias("leader"),
            none.cast("string").alias("leader_text"),
            none.cast("int").alias("score"),
            F.lit(False).alias("is_leader"),
        ).repartition(partitions(spark))
    )
    while True:
        rows = state.where("leader is null and not is_leader").orderBy(F.desc("n"), "id").limit(batch).collect()
        if not rows:
            break
        leaders = _resolve_batch(rows, cutoff, key_first)
        state = cut(_assign(state, leaders, cutoff, key_first, best))
        if 2 * len(leaders) > len(rows):
            # Mostly distinct labels: fewer, larger rounds.
            batch = max(batch, min(2 * batch, _LARGEST_BATCH))
    return state.select(
        "id",
        "text",
        "n",
        F.when(F.col("is_leader"), F.col("id")).otherwise(F.col("leader")).alias("leader"),
        F.when(F.col("is_leader"), F.col("text")).otherwise(F.col("leader_text")).alias("leader_text"),
        F.when(F.col("is_leader"), F.lit(100)).otherwise(F.col("score")).alias("score"),
    )


def _target_batches(choices: DataFrame, size: int) -> Iterator[list]:
    """Choices (choice, text, n) in rank order, a bounded slice at a time."""
    fixed = cut(choices)
    last = None
    while True:
        rest = fixed
        if last is not None:
            rest = fixed.where((F.col("n") < last["n"]) | ((F.col("n") == last["n"]) & (F.col("choice") > last["choice"])))
        rows = rest.orderBy(F.desc("n"), "choice").limit(size).collect()
        if not rows:
            return
        yield rows
        if len(rows) < size:
            return
        last = rows[-1]


def best_match(keys: DataFrame, choices: DataFrame, cutoff: int, batch: int = 4096) -> DataFrame:
    """Best choice of at least ``cutoff`` per distinct key (key, match, score); ties by choice rank.

    ``keys`` holds (key, text), ``choices`` (choice, text, n); the texts are what is compared."""
    schema = "key string, text string, match string, score int"
    state = keys.select("key", "text", F.lit(None).cast("string").alias("match"), F.lit(None).cast("int").alias("score"))
    state = cut(state.repartition(partitions(keys.sparkSession)))

    def pass_for(rows: list):
        names, texts = [r["choice"] for r in rows], [r["text"] for r in rows]

        def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            scorer = TargetScorer(texts, cutoff)
            for pdf in frames:
                pdf["score"] = pdf["score"].astype("Int32")
                for position, found in scorer.matches(pdf["text"].tolist()):
                    if found:
                        t, score = max(found, key=lambda x: (x[1], -x[0]))
                        known = pdf["score"].iat[position]
                        if pd.isna(known) or score > known:
                            pdf.iloc[position, 2] = names[t]
                            pdf.iloc[position, 3] = score
                yield pdf

        return run

    for rows in _target_batches(choices, batch):
        state = cut(state.mapInPandas(pass_for(rows), schema))
    return state.where("match is not null").select("key", "match", "score")


def all_matches(keys: DataFrame, choices: DataFrame, cutoff: int, batch: int = 4096) -> DataFrame:
    """Every (key, choice, score) of at least ``cutoff``: only true matches leave the tasks."""
    fixed = cut(keys.select("key", "text").repartition(partitions(keys.sparkSession)))
    schema = "key string, choice string, score int"
    out = keys.sparkSession.createDataFrame([], schema)

    def pass_for(rows: list):
        names, texts = [r["choice"] for r in rows], [r["text"] for r in rows]

        def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            scorer = TargetScorer(texts, cutoff)
            for pdf in frames:
                labels = pdf["key"].tolist()
                hits = []
                for position, found in scorer.matches(pdf["text"].tolist()):
                    hits += [(labels[position], names[t], s) for t, s in found]
                yield pd.DataFrame(hits, columns=["key", "choice", "score"])

        return run

    for rows in _target_batches(choices, batch):
        out = out.unionByName(fixed.mapInPandas(pass_for(rows), schema))
    return out


def label_counts(df: DataFrame, column: str, ignore: Sequence[str] = ("unknown",)) -> DataFrame:
    """(label, n) of the non-null labels without the ignored ones."""
    c = F.col(quoted(column))
    return df.where(c.isNotNull() & ~c.isin(*ignore)).groupBy(c.alias("label")).agg(F.count("*").alias("n"))


def merge_similar(counts: DataFrame, cutoff: int = 85) -> DataFrame:
    """(label, n, standard, total): each label joins the first more frequent label it resembles, and
    the group's counts add up once."""
    groups = leader_groups(
        counts.select(F.col("label").alias("id"), clean_text("label").alias("text"), "n"), cutoff, best=False, key_first=False
    ).select(F.col("id").alias("label"), "n", F.col("leader").alias("standard"))
    totals = groups.groupBy("standard").agg(F.sum("n").alias("total"))
    return lookup_join(groups, totals, ["standard"], "inner").select("label", "n", "standard", "total")


def rare_label_mapping(counts: DataFrame, min_size: int = 100, parents: DataFrame | None = None, cutoff: int = 70) -> DataFrame:
    """(label, target): frequent labels keep their name; rare ones take the best frequent label by
    token order, else ``<parent>-other``, else ``Other``. ``parents`` holds (label, parent)."""
    fixed = cut(counts)
    major = fixed.where(F.col("n") >= min_size).select(F.col("label").alias("choice"), token_sorted("label").alias("text"), "n")
    rare = fixed.where((F.col("n") < min_size) & (F.col("label") != "unknown"))
    found = best_match(rare.select(F.col("label").alias("key"), token_sorted("label").alias("text")), major, cutoff)
    has_major = major.limit(1).count() > 0
    fallback = F.lit("Other")
    named = rare.join(found.select(F.col("key").alias("label"), "match"), "label", "left")
    if parents is not None and has_major:
        named = named.join(parents.select("label", "parent"), "label", "left")
        fallback = F.when(F.col("parent").isNotNull(), F.concat("parent", F.lit("-other"))).otherwise("Other")
    mapped = named.select("label", F.coalesce("match", fallback).alias("target"))
    kept = fixed.where((F.col("n") >= min_size) | (F.col("label") == "unknown")).select("label", F.col("label").alias("target"))
    return kept.unionByName(mapped)


def commonest_parent(df: DataFrame, child: str, parent: str) -> DataFrame:
    """(label, parent): the most frequent parent of each child, else ``Other``."""
    children = df.where(F.col(quoted(child)).isNotNull()).select(F.col(quoted(child)).alias("label")).distinct()
    best = mode_by(df.where(F.col(quoted(child)).isNotNull()), parent, [child]).select(
        F.col(quoted(child)).alias("label"), F.col("mode").alias("parent")
    )
    return children.join(best, "label", "left").select("label", F.coalesce("parent", F.lit("Other")).alias("parent"))


def simplify_categories(
    df: DataFrame, parent: str, child: str, min_size: int = 100, similar: int = 85
) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Two-level consolidation: normalise, merge similar parents, map rare labels, clear ``unknown``.

    Returns the frame with both columns replaced and the mapping table of each. Merged spellings map to
    the target of their standard name."""
    normal = df.select(*[normalize_label(c).alias(c) if c in (parent, child) else F.col(quoted(c)) for c in df.columns])
    merged = merge_similar(label_counts(normal, parent), similar)
    standard = rare_label_mapping(merged.select(F.col("standard").alias("label"), F.col("total").alias("n")).distinct(), min_size)
    parent_map = lookup_join(merged.select("label", "standard"), standard.withColumnRenamed("label", "standard"), ["standard"], "inner").select("label", "target")
    child_map = rare_label_mapping(label_counts(normal, child), min_size, commonest_parent(normal, child, parent))
    out = map_values(map_values(normal, parent, parent_map, "label", "target"), child, child_map, "label", "target")
    return out, {parent: parent_map, child: child_map}


def _as_text(c: Column, null_text: str) -> Column:
    return F.coalesce(c.cast("string"), F.lit(null_text))


def group_combinations(
    df: DataFrame, fields: Sequence[str], cutoff: int = 85, null_text: str = "nan", counted: bool = False, batch: int = 512
) -> DataFrame:
    """Greedy fuzzy groups of value combinations, one row per combination:
    (group, fields..., frequency, percentage, score, total_frequency, total_percentage).

    The key of a combination is its second and third field; membership compares keys, while the stored
    score compares the whole combination with the group's key (100 for the leader)."""
    fields = list(fields)
    if len(fields) < 2:
        raise ValueError("a combination needs at least two fields")
    log = df if counted else combination_counts(df, fields)
    texts = [_as_text(F.col(quoted(f)), null_text) for f in fields]
    log = cut(
        log.select(
            *[F.col(quoted(f)) for f in fields],
            "frequency",
            F.concat_ws(" ", *texts).alias("__whole"),
            F.concat(texts[1], F.lit(" "), texts[2] if len(fields) > 2 else F.lit("")).alias("__key"),
        ).withColumn("__id", F.to_json(F.struct("__key", *[F.col(quoted(f)) for f in fields]), {"ignoreNullFields": "false"}))
    )
    groups = leader_groups(
        log.select(F.col("__id").alias("id"), clean_text("__key").alias("text"), F.col("frequency").alias("n")), cutoff, batch=batch
    ).select(F.col("id").alias("__id"), F.col("leader").alias("__leader"))
    heads = log.select(F.col("__id").alias("__leader"), F.col("__key").alias("group"))
    joined = lookup_join(log.join(groups, "__id"), heads.join(groups.select("__leader").distinct(), "__leader", "left_semi"), ["__leader"], "inner")
    total = log.agg(F.sum("frequency")).first()[0] or 1
    totals = joined.groupBy("__leader").agg(F.sum("frequency").alias("total_frequency"))
    score = F.when(F.col("__id") == F.col("__leader"), F.lit(100)).otherwise(ratio(F.col("__whole"), F.col("group")))
    return lookup_join(joined, totals, ["__leader"], "inner").select(
        "group",
        *[F.col(quoted(f)) for f in fields],
        "frequency",
        (F.col("frequency") * 100.0 / F.lit(total)).alias("percentage"),
        score.alias("score"),
        "total_frequency",
        (F.col("total_frequency") * 100.0 / F.lit(total)).alias("total_percentage"),
    )


def group_field_sets(df: DataFrame, checks: Sequence[tuple[Sequence[str], str]], cutoff: int = 85) -> dict[str, DataFrame]:
    """Several named field sets in one call."""
    return {name: group_combinations(df, fields, cutoff) for fields, name in checks}


def nest_groups(groups: DataFrame, fields: Sequence[str], members: int = 10_000) -> DataFrame:
    """Groups with their members as an array of structs, most frequent first.

    A group of more than ``members`` combinations comes in several rows, told apart by ``part``, so that
    no array grows without bound."""
    member = F.struct(
        (-F.col("frequency")).alias("order"),
        F.array(*[F.col(quoted(f)).cast("string") for f in fields]).alias("combination"),
        F.col("percentage").alias("combination_percentage"),
        F.col("frequency"),
        F.col("score").alias("fuzzy_score"),
    )
    sizes = groups.groupBy("group").agg(F.ceil(F.count("*") / F.lit(members)).alias("__parts"))
    placed = lookup_join(groups, sizes, ["group"], "inner").withColumn("part", F.pmod(F.xxhash64(*[F.col(quoted(f)) for f in fields]), F.col("__parts")))
    nested = placed.groupBy("group", "part", "total_frequency", "total_percentage").agg(F.array_sort(F.collect_list(member)).alias("m"))
    keep = ("combination", "combination_percentage", "frequency", "fuzzy_score")
    return nested.select(
        "group",
        "part",
        F.transform("m", lambda x: F.struct(*[x[k].alias(k) for k in keep])).alias("combinations"),
        "total_percentage",
        "total_frequency",
    )


def canonical_combinations(groups: DataFrame, fields: Sequence[str], group: str = "group", frequency: str = "frequency") -> DataFrame:
    """Every member takes the fields of its group's most frequent combination; ties by the lowest fields, null first.
    Members without a group are a group of their own."""
    fields = list(fields)
    named = groups.withColumn("__none", F.col(quoted(group)).isNull()).withColumn("__name", F.coalesce(F.col(quoted(group)).cast("string"), F.lit("")))
    head = F.min(F.struct((-F.col(quoted(frequency))).alias("__n"), *[F.col(quoted(f)) for f in fields])).alias("__head")
    best = named.groupBy("__none", "__name").agg(head)
    joined = lookup_join(named, best, ["__none", "__name"], "inner")
    return joined.select(*[F.col(f"__head.{quoted(c)}").alias(c) if c in fields else F.col(quoted(c)) for c in groups.columns])
