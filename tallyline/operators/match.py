"""Candidate scoring and best matches between two sources.

A pair is a candidate when it agrees on at least one filled key. ``best_match`` keeps, for every
left id, the candidate with the lowest level and then the highest confidence. It never lists the
pairs of a key: equal names are found by a hash join, and only names without an equal are compared
with the distinct names of their key, which travel as bounded arrays.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.functions import similarity_sql, weighted_score_sql
from tallyline.operators.joins import filled_sql, key_entries
from tallyline.operators.skew import frequent_items, hot_items, hot_keys, names_sql, skew_join

# Distinct right-hand names held in one array row, and the probes that meet such an array in one place.
BLOCK_SIZE = 2048
PROBES = 256
# Keys of more right rows than this look for names within so many edits by their deletions, before any are compared.
NEAR_FROM = ((1, 64), (2, 512))
# Similarity is rounded to four places.
FOUR_PLACES = 0.00005
# Level of a pair that meets no rule.
NO_MATCH = 99


@dataclass(frozen=True)
class Dimension:
    """One part score: 1.0 where ``exact`` agrees, otherwise the similarity of ``column``.

    ``exact`` defaults to ``column``; otherwise it is the strongest level of the spec.
    """

    name: str
    column: str
    weight: float
    exact: str | None = None


@dataclass(frozen=True)
class MatchSpec:
    """``levels``: key columns, strongest first. ``fuzzy``: (column, least similarity) that must all hold."""

    levels: Sequence[str]
    dimensions: Sequence[Dimension]
    fuzzy: Sequence[tuple[str, float]] = ()

    def __post_init__(self) -> None:
        for d in self.dimensions:
            if d.exact not in (None, d.column, self.levels[0]):
                raise ValueError(f"{d.name}: exact must be {d.column} or {self.levels[0]}")


def _count_parts(parts: Sequence[str]) -> str:
    return " + ".join(f"CASE WHEN {p} IS NULL THEN 0 ELSE 1 END" for p in parts)


def score_pairs(pairs: DataFrame, spec: MatchSpec, compare_blanks: bool = False) -> DataFrame:
    """Add level, part scores, number of scored parts and confidence to ``l_*``/``r_*`` pairs.

    A column absent from one side counts as blank. By default a part that is blank on either side
    is left out and the weights of the others are scaled up; ``compare_blanks`` scores blanks as
    empty strings and keeps the weights as they are.
    """
    present = set(pairs.columns)

    def sides(name: str) -> tuple[str, str]:
        return tuple(
            f"coalesce(CAST({p}{name} AS STRING), '')" if p + name in present else "''" for p in ("l_", "r_")
        )

    def equal(name: str) -> str:
        a, b = sides(name)
        return f"({a} <> '' AND {a} = {b})"

    levels = [f"WHEN {equal(k)} THEN {i + 1}" for i, k in enumerate(spec.levels)]
    if spec.fuzzy:
        near = []
        for column, least in spec.fuzzy:
            a, b = sides(column)
            near.append(f"{similarity_sql(a, b)} >= {least}D")
            if not compare_blanks:
                near.append(f"{a} <> '' AND {b} <> ''")
        levels.append(f"WHEN {' AND '.join(near)} THEN {len(spec.levels) + 1}")
    scores = []
    for d in spec.dimensions:
        a, b = sides(d.column)
        close = similarity_sql(a, b)
        if not compare_blanks:
            close = f"CASE WHEN {a} <> '' AND {b} <> '' THEN {close} END"
        scores.append(f"CASE WHEN {equal(d.exact or d.column)} THEN 1.0D ELSE {close} END AS {d.name}_match_score")
    parts = [f"{d.name}_match_score" for d in spec.dimensions]
    weighted = list(zip(parts, [d.weight for d in spec.dimensions]))
    return (
        pairs.selectExpr("*", f"CASE {' '.join(levels)} ELSE {NO_MATCH} END AS match_level", *scores)
        .where(f"match_level < {NO_MATCH}")
        .selectExpr(
            "*",
            f"{_count_parts(parts)} AS scored_dims",
            f"{weighted_score_sql(weighted, not compare_blanks)} AS overall_match_confidence",
        )
    )


def _part_scores(spec: MatchSpec, score: Callable[[str], str | None]) -> list[str]:
    """SQL for the part scores of a pair, from that of a name column (None where it is not on both sides)."""
    scores = []
    for d in spec.dimensions:
        part = score(d.column) or "CAST(NULL AS DOUBLE)"
        if d.exact == spec.levels[0] and d.exact != d.column:
            part = f"CASE WHEN _rank = 1 THEN 1.0D ELSE {part} END"
        scores.append(part)
    return scores


def _best_of(spec: MatchSpec, names: Sequence[str], members: str) -> str:
    """SQL for the best of an array of right rows, as a struct whose smallest is best.

    Part scores are computed in a first pass over the array, so that each similarity is worked out once.
    """

    def score(column: str) -> str | None:
        if column not in names:
            return None
        a, b = f"_n_{column}", f"x._n_{column}"
        return f"CASE WHEN {a} = '' OR {b} = '' THEN NULL WHEN {a} = {b} THEN 1.0D ELSE {similarity_sql(a, b)} END"

    scores = [f"{part} AS {d.name}_match_score" for d, part in zip(spec.dimensions, _part_scores(spec, score))]
    parts = [f"y.parts.{d.name}_match_score" for d in spec.dimensions]
    confidence = weighted_score_sql(list(zip(parts, [d.weight for d in spec.dimensions])))
    scored = f"transform({members}, x -> struct(struct({', '.join(scores)}) AS parts, x._right AS _right))"
    return (
        f"array_min(transform({scored}, y -> struct(-({confidence}) AS loss, -({_count_parts(parts)}) AS gaps, "
        "y._right AS _right, y.parts AS parts)))"
    )


def _nameless_wins(spec: MatchSpec, names: Sequence[str]) -> str:
    """SQL: no right row with another name can beat one without a name, whatever the names of the key.

    A different name is one edit away at least, so its similarity is at most 1 - 1 / (length + 1). With more
    than one name column nothing is said.
    """
    if len(names) != 1:
        return "false"
    weights = [d.weight for d in spec.dimensions]
    nearest = f"round(1 - 1 / (length(_n_{names[0]}) + 1), 4)"
    confidences = [
        weighted_score_sql(list(zip(_part_scores(spec, score), weights)))
        for score in (lambda c: nearest if c in names else None, lambda c: None)
    ]
    return f"(_n_{names[0]} <> '' AND ({confidences[0]}) < ({confidences[1]}))"


def _settled_within(spec: MatchSpec, name: str, edits: int) -> str:
    """SQL: a right name within ``edits`` edits of the left one beats all names further away.

    A name that is ``d`` edits away is at most ``d`` letters longer, so its similarity is at most 1 - d / (length + d).
    """
    weights = [d.weight for d in spec.dimensions]
    near, far = f"round(1 - {edits} / greatest(length(_n_{name}), 1), 4)", f"round(1 - {edits + 1} / (length(_n_{name}) + {edits + 1}), 4)"
    at_near, at_far = (weighted_score_sql(list(zip(_part_scores(spec, lambda c, at=at: at if c == name else None), weights))) for at in (near, far))
    return f"(length(_n_{name}) > {edits} AND ({at_near}) > ({at_far}))"


def _deletions_sql(value: str, edits: int) -> str:
    """Hashes of all that is left of a text without up to ``edits`` of its characters."""
    left = f"array({value})"
    for _ in range(edits):
        one = "transform(sequence(1, greatest(length(v), 1)), i -> concat(substring(v, 1, i - 1), substring(v, i + 1)))"
        left = f"array_distinct(flatten(transform({left}, v -> array_append({one}, v))))"
    return f"transform({left}, v -> xxhash64(v))"


def near_names(probes: DataFrame, held: DataFrame, key: Sequence[str], name: str, edits: int) -> DataFrame:
    """All pairs of a key that are at most ``edits`` edits apart: the probe's columns and ``_near``, perhaps repeated.

    Two such texts are the same without so many characters of each, so they meet by a hash join. The names
    that share what is left are as many as there are letters to put back, however crowded the key.
    """
    asked = probes.where(f"{name} <> ''").selectExpr(*key, name, f"explode({_deletions_sql(name, edits)}) AS _left")
    there = held.where(f"{name} <> ''").selectExpr(*key, f"{name} AS _near", f"explode({_deletions_sql(name, edits)}) AS _left")
    return asked.join(there, [*key, "_left"]).where(f"levenshtein({name}, _near, {edits}) >= 0").select(*key, name, "_near")


def _as_it_is(df: DataFrame) -> DataFrame:
    return df


def _at_equal_names(rows: DataFrame, there: DataFrame, n_cols: Sequence[str], named: str, crowded: DataFrame | bool) -> DataFrame:
    """``rows`` with ``_equal``, the first right row of the same key and names; rows without a key or name have none."""
    equals = there.where(named)
    on = ["_rank", "_value", *n_cols]
    if crowded is not False:
        equals = equals.groupBy(*on).agg(F.expr("min(_right) AS _equal"))
        return skew_join(rows, equals, on, "left", hot=crowded, hot_on=on[:2])
    # rows that ask for nothing are spread; the right side is grouped as the join needs it and shuffled once
    free = f"CASE WHEN _value IS NOT NULL AND {named} THEN 0L ELSE pmod(xxhash64({names_sql(rows.columns)}), 65536L) + 1 END AS _spread"
    equals = equals.selectExpr("*", "pmod(xxhash64(_value), 1L) AS _spread").groupBy(*on[1:], "_spread").agg(F.expr("min(_right) AS _equal"))
    return rows.selectExpr("*", free).join(equals, [*on[1:], "_spread"], "left").drop("_spread")


# How the key of a level was met: by an equal name, by a row without a name that no name can beat, by others.
EQUAL, NAMELESS, OPEN = range(3)


def best_match(
    left: DataFrame,
    right: DataFrame,
    spec: MatchSpec,
    left_id: str,
    right_order: Sequence[Column],
    block_size: int = BLOCK_SIZE,
    stage: Callable[[DataFrame], DataFrame] | None = None,
    shown: tuple[Sequence[str], Sequence[str]] | None = None,
) -> DataFrame:
    """Per ``left_id`` the best candidate: level, then confidence, then parts scored, then ``right_order``.

    ``right_order`` lists expressions over the right columns, the smaller being preferred. ``shown`` names the
    left and right columns wanted in the result, by default all; they come out as ``l_*`` and ``r_*``, and
    only they are carried along.

    1. Levels are gone through in turn, with the left rows that no level before has met. Right rows with the
       same key and names score alike, so one of them is kept per key.
    2. A hash join finds a right row with the very same names. Such a pair scores 1.0 in every part and
       cannot be beaten. Left rows without one learn whether their key is there and how often.
    3. Only these are compared with the names of their key. With ``stage`` and one name column, a crowded key
       is first searched for names one and two edits away (``near_names``), which nothing further away can beat.
       The other names lie in arrays of about ``block_size``, so a crowded key is spread over many rows and
       tasks and no pair is ever a row. Equal probes are compared once, and none where a row without a name,
       which is judged by the other parts alone, wins whatever the names.
    4. Ids that no key finds are compared by the fuzzy rule, if both sides have its columns: names that are
       similar in all of them meet on rare grams (``similar_tuples``), so no key is shared and no pair missed.

    ``stage`` may store the intermediate tables that are read several times (see sources.staged); with a
    fuzzy rule it should, since all of the plan up to there is otherwise repeated.
    """
    both = [c for c in left.columns if c in right.columns]
    names = list(dict.fromkeys(d.column for d in spec.dimensions if d.column in both))
    levels = [c for c in spec.levels if c in both]
    ranks = [spec.levels.index(c) + 1 for c in levels]
    l_shown, r_shown = shown or (left.columns, right.columns)
    l_shown = list(dict.fromkeys([left_id, *l_shown]))
    l_cols, r_cols = [f"l_{c}" for c in l_shown], [f"r_{c}" for c in r_shown]
    n_cols = [f"_n_{c}" for c in names]
    key = ["_rank", "_value"]
    staging = stage is not None
    stage = stage or _as_it_is

    def with_names(df: DataFrame, prefix: str) -> DataFrame:
        """Columns prefixed, and the names as text."""
        prefixed = df.toDF(*[c if c == "_order" else prefix + c for c in df.columns])
        return prefixed.selectExpr("*", *[f"coalesce(CAST(`{prefix}{c}` AS STRING), '') AS _n_{c}" for c in names])

    def entries(df: DataFrame, prefix: str) -> DataFrame:
        return key_entries(df, [prefix + c for c in levels], ranks)

    named = " AND ".join(f"{c} <> ''" for c in n_cols) or "true"
    nameless = " AND ".join(f"{c} = ''" for c in n_cols) or "false"
    order = F.struct(*[o.alias(f"o{i}") for i, o in enumerate(right_order or [F.lit(0)])]).alias("_order")
    lefts = with_names(left, "l_").select(*dict.fromkeys([*l_cols, *[f"l_{c}" for c in levels]]), *n_cols)
    rights = with_names(right.select("*", order), "r_").selectExpr(
        *[f"`r_{c}`" for c in levels], *n_cols, f"struct(_order, {names_sql(r_cols)}) AS _right"
    )
    # keys crowded on either side, found in one pass each and used by all the joins below
    crowded_left, crowded_right = hot_keys(entries(lefts, "l_"), key), hot_keys(entries(rights, "r_"), key)
    if staging:  # stored lists are read by every join below, and where none is crowded no join has to part rows
        crowded_left, crowded_right = (False if x.isEmpty() else x for x in (stage(crowded_left), stage(crowded_right)))

    # 1. and 2. level by level
    rows, done = lefts, []
    for rank, level in zip(ranks, levels):
        before = "_hit" in rows.columns
        open_yet = filled_sql(f"l_{level}") + (" AND _hit IS NULL" if before else "")
        asking = rows.selectExpr("*", f"{rank} AS _rank", f"CASE WHEN {open_yet} THEN CAST(`l_{level}` AS STRING) END AS _value")
        there = rights.where(filled_sql(f"r_{level}")).selectExpr(f"{rank} AS _rank", f"CAST(`r_{level}` AS STRING) AS _value", *n_cols, "_right")
        if staging and done:  # only a part of the left rows is left, and of the right rows those of their keys
            there = stage(skew_join(there, asking.where("_value IS NOT NULL").select(*key).distinct(), key, "left_semi", hot=crowded_right))
        met = _at_equal_names(asking, there, n_cols, named, crowded_left).withColumn("_value", F.expr("CASE WHEN _equal IS NULL THEN _value END"))
        sizes = there.groupBy(*key).agg(F.count("*").alias("_size"), F.expr(f"min(CASE WHEN {nameless} THEN _right END) AS _nameless"))
        met = skew_join(met, sizes, key, "left", hot=crowded_left)
        state = f"CASE WHEN _equal IS NOT NULL THEN {EQUAL} WHEN _nameless IS NOT NULL AND {_nameless_wins(spec, names)} THEN {NAMELESS} ELSE {OPEN} END"
        hit = f"CASE WHEN _equal IS NOT NULL OR _size IS NOT NULL THEN struct(_rank, _value, _size, {state} AS _state, coalesce(_equal, _nameless) AS _right) END"
        rows = met.selectExpr(*[f"`{c}`" for c in lefts.columns], f"{f'coalesce(_hit, {hit})' if before else hit} AS _hit")
        if staging:
            rows = stage(rows)
            done.append(rows.where("_hit IS NOT NULL"))
            rows = rows.where("_hit IS NULL").drop("_hit")
            if rows.isEmpty():
                break
    if not staging:
        done.append(rows.where("_hit IS NOT NULL"))
    nearest = reduce(DataFrame.unionByName, done).selectExpr(*[f"`{c}`" for c in l_cols], *n_cols, "_hit.*")
    met_names = [f"CASE WHEN _state = {EQUAL} THEN {c} ELSE '' END AS {c}" for c in n_cols]
    itself = f"array(struct({', '.join([*met_names, '_right'])}))"
    settled = nearest.where(f"_state < {OPEN}").selectExpr(*[f"`{c}`" for c in l_cols], "_rank", f"{_best_of(spec, names, itself)} AS _best")
    every = settled

    # 3. the others against the names of their key, a block of names at a time
    open_rows = nearest.where(f"_state = {OPEN}")
    if names and not (staging and open_rows.isEmpty()):
        open_probes = open_rows.select(*key, "_size", *n_cols).distinct()
        open_keys = stage(open_probes.groupBy(*key, "_size").agg(F.count("*").alias("_asked")))
        held = (
            skew_join(entries(rights, "r_").select(*key, *n_cols, "_right"), open_keys, key, hot=crowded_right)
            .groupBy(*key, "_size", "_asked", *n_cols)
            .agg(F.expr("min(_right) AS _right"))
        )
        open_probes = skew_join(open_probes.drop("_size"), open_keys, key, hot=crowded_left)
        near = []
        if staging and len(names) == 1 and not open_keys.where(f"_size > {NEAR_FROM[0][1]}").isEmpty():
            held, open_probes = stage(held), stage(open_probes)
            for edits, size in NEAR_FROM:
                there = held.where(f"_size > {size}")
                asked = open_probes.where(f"_size > {size} AND {_settled_within(spec, names[0], edits)}")
                pairs = stage(near_names(asked, there, key, n_cols[0], edits).distinct())
                # a right row without a name is judged by the other parts, so it is looked at beside them
                pairs = pairs.unionByName(pairs.select(*key, *n_cols, F.lit("").alias("_near")).distinct())
                members = there.selectExpr(*key, f"{n_cols[0]} AS _near", f"struct({n_cols[0]}, _right) AS _member")
                met = pairs.join(members, [*key, "_near"]).selectExpr(*key, *n_cols, f"{_best_of(spec, names, 'array(_member)')} AS _best")
                near.append(stage(met.groupBy(*key, *n_cols).agg(F.expr("min(_best) AS _best"))))
                open_probes = stage(open_probes.join(near[-1].select(*key, *n_cols), [*key, *n_cols], "left_anti"))
        # a block of names and some probes at a time, dealt out by their number: they are few bytes and much work
        places = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        unit = [*key, "_block", "_part"]
        blocks = (
            held.selectExpr("*", f"pmod(xxhash64({', '.join(n_cols)}), ceil(_size / {block_size})) AS _block")
            .groupBy(*key, "_asked", "_block")
            .agg(F.expr(f"collect_list(struct({', '.join([*n_cols, '_right'])})) AS _members"))
            .selectExpr(*key, "_block", "_members", f"explode(sequence(0L, ceil(_asked / {PROBES}) - 1)) AS _part")
        )
        probes = open_probes.selectExpr(
            *key, *n_cols, f"explode(sequence(0L, ceil(_size / {block_size}) - 1)) AS _block",
            f"pmod(xxhash64({', '.join(n_cols)}), ceil(_asked / {PROBES})) AS _part",
        )
        compared = (
            probes.repartition(places, *unit)
            .join(blocks.repartition(places, *unit), unit)
            .selectExpr(*key, *n_cols, f"{_best_of(spec, names, '_members')} AS _best")
        )
        compared = reduce(DataFrame.unionByName, near, compared).groupBy(*key, *n_cols).agg(F.expr("min(_best) AS _best"))
        searched = skew_join(
            open_rows.select(*l_cols, *key, *n_cols), compared, [*key, *n_cols], hot=crowded_left, hot_on=key
        )
        every = settled.unionByName(searched.select(*l_cols, "_rank", "_best"))

    # 4. ids without any candidate so far, by similar names alone
    fuzzy = [c for c, _ in spec.fuzzy]
    if fuzzy and all(c in names for c in fuzzy):
        level, likes = len(spec.levels) + 1, [f"_n_{c}" for c in fuzzy]
        every = stage(every)
        lost = stage(lefts.select(*l_cols, *n_cols).join(every.select(f"l_{left_id}"), f"l_{left_id}", "left_anti"))
        kept = stage(rights.groupBy(*n_cols).agg(F.expr("min(_right) AS _right")))
        met = similar_tuples(lost.select(*likes), kept.select(*likes), [least for _, least in spec.fuzzy])
        met = stage(met.select(*[f"l_{i}" for i in range(len(likes))], *[f"r_{i}" for i in range(len(likes))]))
        kept = kept.select(*[F.col(c).alias(f"r_{i}") for i, c in enumerate(likes)], F.struct(*n_cols, "_right").alias("_member"))
        asked = lost.select(*n_cols).distinct().select("*", *[F.col(c).alias(f"l_{i}") for i, c in enumerate(likes)])
        on = [f"l_{i}" for i in range(len(likes))]
        close = skew_join(asked, met, on, hot_right=True)
        close = skew_join(close, kept, [f"r_{i}" for i in range(len(likes))], hot_right=True)
        close = close.selectExpr(*n_cols, f"{level} AS _rank", f"{_best_of(spec, names, 'array(_member)')} AS _best")
        close = close.groupBy(*n_cols).agg(F.expr("min(struct(_rank, _best)) AS _hit")).select(*n_cols, "_hit.*")
        found = skew_join(lost, close, n_cols).select(*l_cols, "_rank", "_best")
        every = every.unionByName(found)

    best = f"min(struct(_rank, _best.loss, _best.gaps, _best._right, _best.parts, {names_sql(l_cols)})) AS _top"
    return (
        every.groupBy(F.col(f"l_{left_id}").alias("_id"))
        .agg(F.expr(best))
        .selectExpr(
            *[f"_top.`{c}` AS `{c}`" for c in l_cols],
            *[f"_top._right.`{c}` AS `{c}`" for c in r_cols],
            "_top._rank AS match_level",
            *[f"_top.parts.{d.name}_match_score" for d in spec.dimensions],
            "-_top.gaps AS scored_dims",
            "-_top.loss AS overall_match_confidence",
        )
    )


def _grams(df: DataFrame, gram: int) -> DataFrame:
    """Every substring of ``gram`` characters of the padded value ``_v``."""
    pad = f"repeat(chr(1), {gram - 1})"
    return df.selectExpr(
        "_v",
        f"explode(transform(sequence(1, length(_v) + {gram - 1}), "
        f"i -> substring(concat({pad}, _v, {pad}), i, {gram}))) AS _gram",
    )


def _common_grams(values: DataFrame, gram: int) -> tuple[DataFrame, DataFrame]:
    """The most frequent grams, 1024 or one per partition, so what is broadcast has a fixed size; and the hot ones."""
    partitions = int(values.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    common = frequent_items(_grams(values, gram), "_gram", max(1024, partitions), max(1024, partitions))
    hot = hot_items(common, partitions).selectExpr("xxhash64(_hot) AS _hot", "_parts")
    return F.broadcast(common.selectExpr("inline(_top) AS (_gram, _n)")), hot


def _rarest_grams(values: DataFrame, common: DataFrame, floor: float, gram: int) -> DataFrame:
    """``_v, _set``: so many of the rarest grams of each value that a similar one shares one of its own.

    ``values`` is already partitioned by value, so nothing is shuffled.
    """
    keep = f"CAST(floor(length(_v) * {1 - floor}D / {floor}D) * {gram} + 1 AS INT)"
    return (
        _grams(values, gram)
        .join(common, "_gram", "left")
        .groupBy("_v")
        .agg(F.expr("array_sort(collect_list(struct(coalesce(_n, 0L) AS n, xxhash64(_gram) AS h, _gram AS g))) AS _all"))
        .selectExpr("_v", f"array_distinct(slice(_all, 1, {keep}).g) AS _set")
    )


def similar_tuples(left: DataFrame, right: DataFrame, least: Sequence[float], gram: int = 3) -> DataFrame:
    """All pairs of distinct rows that are similar in every column: ``l_0, l_1, ..., r_0, ..., similarity_0, ...``.

    Both sides have one string column for each of ``least`` (0.75 or more each); rows with an empty one are
    left out. Nothing is missed: similar values share one of their rarest grams, so rows meet on one such
    gram of every column at once. A column that a third of all rows have in common is parted by the others.
    """
    if min(least) < 0.75:
        raise ValueError("similar_tuples needs least similarities of 0.75 or more")
    columns = range(len(least))
    values = [f"_v{i}" for i in columns]

    def tuples(df: DataFrame) -> DataFrame:
        rows = df.toDF(*values).selectExpr(*[f"CAST({v} AS STRING) AS {v}" for v in values])
        return rows.where(" AND ".join(f"{v} <> ''" for v in values)).distinct()

    sides = {"l": tuples(left), "r": tuples(right)}
    for i in columns:
        single = {side: rows.select(F.col(f"_v{i}").alias("_v")).distinct() for side, rows in sides.items()}
        common, _ = _common_grams(single["l"].unionByName(single["r"]), gram)
        for side in sides:
            sets = _rarest_grams(single[side], common, least[i] - FOUR_PLACES, gram)
            hashed = sets.selectExpr(f"_v AS _v{i}", f"transform(_set, x -> xxhash64(x)) AS _s{i}")
            sides[side] = skew_join(sides[side], hashed, [f"_v{i}"])

    def entries(side: str) -> DataFrame:
        rows = sides[side].select(*[F.col(f"_v{i}").alias(f"{side}_{i}") for i in columns], *[F.col(f"_s{i}").alias(f"_{side}_s{i}") for i in columns])
        for i in columns:
            rows = rows.withColumn(f"_g{i}", F.explode(f"_{side}_s{i}"))
        return rows

    on = [f"_g{i}" for i in columns]
    met = skew_join(entries("l"), entries("r"), on, hot_right=True)
    for i in columns:
        lengths = f"length(l_{i}), length(r_{i})"
        # a pair that shares several grams is kept at the first of each column only
        first_met = f"array_min(array_intersect(_l_s{i}, _r_s{i})) = _g{i}"
        met = met.where(f"least({lengths}) >= greatest({lengths}) * {least[i] - FOUR_PLACES}D AND {first_met}")
    for i in columns:
        met = met.withColumn(f"similarity_{i}", F.expr(similarity_sql(f"l_{i}", f"r_{i}"))).where(F.col(f"similarity_{i}") >= least[i])
    return met.select(*[f"l_{i}" for i in columns], *[f"r_{i}" for i in columns], *[f"similarity_{i}" for i in columns])


def similar_values(left: DataFrame, right: DataFrame, least: float, gram: int = 3) -> DataFrame:
    """All (l_value, r_value, similarity) with similarity of at least ``least`` (0.75 or more).

    ``left`` and ``right`` have one string column. Nothing is missed: strings within k edits share
    one of their ``gram * k + 1`` rarest grams, so only those are joined, and lengths prune
    further. A frequent gram is left out unless a string has nothing rarer.
    """
    if least < 0.75:
        raise ValueError("similar_values needs a least similarity of 0.75 or more")
    floor = least - FOUR_PLACES

    def values(df: DataFrame) -> DataFrame:
        return df.toDF("_v").selectExpr("CAST(_v AS STRING) AS _v").where("_v <> ''").distinct()

    lefts, rights = values(left), values(right)
    common, hot = _common_grams(lefts.unionByName(rights), gram)

    def prefixes(df: DataFrame, side: str) -> DataFrame:
        sets = _rarest_grams(df, common, floor, gram)
        return sets.selectExpr(f"_v AS {side}_value", f"_set AS _{side}_set", "explode(_set) AS _gram")

    met = skew_join(prefixes(lefts, "l"), prefixes(rights, "r"), ["_gram"], hot=hot, hot_right=hot)
    lengths = "length(l_value), length(r_value)"
    # a pair that shares several grams is kept at the first of them only
    first_met = "array_min(array_intersect(_l_set, _r_set)) = _gram"
    return (
        met.where(f"least({lengths}) >= greatest({lengths}) * {floor}D AND {first_met}")
        .selectExpr("l_value", "r_value", f"{similarity_sql('l_value', 'r_value')} AS similarity")
        .where(F.col("similarity") >= least)
    )
