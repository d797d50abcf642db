"""Identity resolution: which records describe the same entity.

The specification compares every pair that shares a block.  Written out, that
is quadratic in the largest block, so no operator here does it:

* Deterministic keys are transitive.  Each key group becomes links from its
  members to one root: n-1 rows instead of n(n-1)/2.
* Records that agree on every compared column are one *profile*; a decision
  depends on those columns only and is made once per pair of profiles.
* A fuzzy pair is formed only where its score can still reach the wanted
  floor.  The weights say which exact features must agree for that, or that
  texts must be equal or contained in each other, so the join runs on those
  values and not on whole blocks.  With the floor at 0 the same code returns
  every compared pair, for small inputs.
* Pairs below the floor are counted exactly from group sizes (`match_bands`).
* A join group above `split_rows` profiles is cut into tiles spread over tasks.
* Where whole blocks meet, and in large join groups, pairs are scored as matrices
  tile by tile: only those that reach the floor, or their counts, become rows.
* Where few texts recur in a join group, texts are measured once per pair of
  texts and only pairs of profiles that can still reach the floor are formed.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from itertools import chain, combinations, takewhile

from pyspark.sql import Column, DataFrame, functions as F

from kinfold.functions import similarity as sim, tiles
from kinfold.operators.components import connected_components
from kinfold.session import materialize
from kinfold.spec import Matching

MATCH, REVIEW, REJECTED, NO_MATCH = "MATCH", "REVIEW", "REJECTED_FP_GUARD", "NO_MATCH"
ROUNDING = 5e-5  # scores are rounded to four digits before they meet a threshold
SPLIT_ROWS = 5_000
RECURRING_ROWS = 32  # join groups of this many profiles on, with half as many texts at most, meet by their texts
TILE_SIDE = 2_500  # records on either side of a tile scored as matrices: some 100 MB of a Python worker if all their texts differ
TILE_ROWS = 512  # join groups of this many profiles on meet as matrices, tile by tile
PAIR_COLUMNS = ["record_uid_1", "record_uid_2", "record_pairs", "score", "method", "decision"]


# ---------------------------------------------------------------- blocking

def block_keys(records: DataFrame, spec: Matching) -> DataFrame:
    """(record_uid, block_key): one narrow row per record and non-null key."""
    keys = F.array_distinct(F.array_compact(F.array(*[F.expr(b.expr) for b in spec.blocking])))
    return records.select("record_uid", F.explode(keys).alias("block_key"))


def block_sizes(records: DataFrame, spec: Matching) -> DataFrame:
    """Records and pairs per block: what a key costs, before anything is compared."""
    return (block_keys(records, spec).groupBy("block_key").agg(F.count("*").alias("n_records"))
            .withColumn("n_pairs", _pairs_of("n_records")))


def oversize_blocks(records: DataFrame, spec: Matching, limit: int) -> DataFrame:
    """Report of blocks above a size; they are split, never dropped."""
    return block_sizes(records, spec).filter(F.col("n_records") > limit)


def _pairs_of(count: str | Column) -> Column:
    n = (F.col(count) if isinstance(count, str) else count).cast("decimal(19,0)")
    return (n * (n - 1) / 2).cast("decimal(38,0)")


# ---------------------------------------------------------------- deterministic keys

def _implied(spec: Matching, key: tuple[str, ...]) -> bool:
    """Do equal key values always share a block?  Then the block need not be part of the group."""
    return any(set(b.columns) <= set(key) for b in spec.blocking)


def key_groups(records: DataFrame, spec: Matching) -> DataFrame:
    """(record_uid, det_key, group): membership in every deterministic key group, within shared blocks."""
    entries = []
    for key in spec.deterministic:
        filled = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in key])
        # Only blocks made of the key's own columns follow from it; any other block joins the group key.
        blocks = [b for b in spec.blocking if set(b.columns) <= set(key)] if _implied(spec, key) else spec.blocking
        for b in blocks if not _implied(spec, key) else blocks[:1]:
            parts = [F.lit(b.name), F.expr(b.expr), *[F.col(c) for c in key]]
            group = F.unhex(F.sha2(F.to_json(F.array(*[p.cast("string") for p in parts])), 256))
            entries.append(F.when(filled & F.expr(b.expr).isNotNull(), F.struct(
                F.lit("+".join(key)).alias("det_key"), group.alias("group"))))
    return records.select("record_uid", F.inline(F.array_compact(F.array(*entries))))


def deterministic_links(records: DataFrame, spec: Matching) -> DataFrame:
    """(record_uid, det_key, root_uid): every member of a shared key linked to the group's largest uid.

    Two records are a deterministic match exactly if they have the same root
    under some key.  Roots themselves are not listed.
    """
    members = key_groups(records, spec)
    roots = (members.groupBy("group").agg(F.max("record_uid").alias("root_uid"), F.count("*").alias("n"))
             .filter("n > 1").drop("n"))
    return (members.join(roots, "group").filter("record_uid != root_uid")
            .select("record_uid", "det_key", "root_uid"))


# ---------------------------------------------------------------- profiles and evidence

def profiles(records: DataFrame, spec: Matching, carried: tuple[str, ...] = ()) -> DataFrame:
    """Distinct combinations of the compared columns with their record count and uid range.

    `carried` are other columns, shown as the first record has them.
    """
    return records.groupBy(*spec.columns).agg(
        F.count("*").alias("n_records"), F.min("record_uid").alias("first_uid"), F.max("record_uid").alias("last_uid"),
        *[F.min_by(c, "record_uid").alias(f"__c_{c}") for c in carried])


def profile_members(records: DataFrame, spec: Matching) -> DataFrame:
    """(record_uid, first_uid): which profile stands for a record in the pair table."""
    values = F.to_json(F.array(*[F.col(c).cast("string") for c in spec.columns]), {"ignoreNullFields": "false"})
    narrow = records.select("record_uid", F.unhex(F.sha2(values, 256)).alias("profile"))
    return narrow.join(narrow.groupBy("profile").agg(F.min("record_uid").alias("first_uid")), "profile").select("record_uid", "first_uid")


def _subsets(items) -> chain:
    items = list(items)
    return chain.from_iterable(combinations(items, n) for n in range(len(items) + 1))


def reachable_evidence(spec: Matching, floor: float) -> list[tuple[str, ...]] | None:
    """Minimal sets of exact features a non-deterministic pair must agree on to score `floor`.

    `[()]` means nothing need agree; None means that no pair can reach it.
    """
    exact = {f.attribute: f.weight for f in spec.features if f.method == "exact"}
    fuzzy = sum(f.weight for f in spec.features if f.method != "exact")
    reach = [
        s for s in _subsets(exact)
        if sum(exact[a] for a in s) + fuzzy >= floor - ROUNDING and not any(set(k) <= set(s) for k in spec.deterministic)
    ]
    if not reach:
        return None
    return [s for s in reach if not any(set(t) < set(s) for t in reach)]


@dataclass(frozen=True)
class Slot:
    """One way for two profiles to meet.

    All `keys` (columns of the profile table) are equal; with `inside`, the
    tokens of one side also contain those of the other.  `any_block` slots
    check per pair that a block is shared, the others have it in their key.
    `equal` are the exact features that agree here; `settled` if nothing else
    need agree for the slot.
    """

    keys: tuple[str, ...]
    inside: str | None = None
    any_block: bool = False
    equal: tuple[str, ...] = ()
    settled: bool = False


def _slots(spec: Matching, floor: float) -> tuple[dict[str, Column], list[Slot]]:
    """Key columns and slots such that every pair able to reach `floor` meets in at least one."""
    minimal = reachable_evidence(spec, floor)
    if minimal is None:
        return {}, []
    columns, slots = {}, []
    if minimal == [()]:
        columns, slots = _fuzzy_slots(spec, floor)
        if not slots:  # nothing can be said about the pair beyond its block
            return {}, [Slot((f"__b{i}",)) for i in range(len(spec.blocking))]
        minimal = [(f.attribute,) for f in spec.features
                   if f.method == "exact" and (f.attribute,) not in spec.deterministic]
    agreeing = []
    for j, equal in enumerate(minimal):
        columns[f"__e{j}"] = _joined([F.col(c) for c in equal])
        # Values that settle a block need no other block: whoever shares them shares that block.
        implied = [i for i, b in enumerate(spec.blocking) if set(b.columns) <= set(equal)]
        agreeing += [Slot((f"__e{j}",) if implied else (f"__b{i}", f"__e{j}"), equal=equal, settled=bool(implied))
                     for i in implied[:1] or range(len(spec.blocking))]
    return columns, agreeing + slots


def _fuzzy_slots(spec: Matching, floor: float) -> tuple[dict[str, Column], list[Slot]]:
    """Slots for pairs without any agreeing exact feature, when the floor asks for almost equal texts.

    Each fuzzy feature then needs a similarity so close to 1 that shorter texts
    must be equal (token_sort) or one inside the other (token_set): below 1
    either ratio is at most 1 - 1/(|a|+|b|).  Longer texts meet under a common
    mark instead and are compared as they are.
    """
    fuzzy = [f for f in spec.features if f.method != "exact"]
    spare = sum(f.weight for f in fuzzy) - floor + ROUNDING

    def longest(f) -> int:
        least = 1.0 - spare / f.weight
        return int(least / (2 * (1 - least))) - 1 if least > 0 else 0

    usable = [f for f in fuzzy if longest(f) >= 64]
    ordered = next((f for f in usable if f.method == "token_sort_ratio"), None)
    if ordered is None:
        return {}, []
    form = sim.sorted_tokens(F.col(ordered.attribute))
    form = F.when(F.length(form) < longest(ordered), form).when(form.isNotNull(), F.lit("*long*"))
    contained = next((f for f in usable if f.method == "token_set_ratio"), None)
    if contained is None:
        return {"__form": form}, [Slot(("__form",), any_block=True)]
    words = F.array_distinct(sim.tokens(F.col(contained.attribute)))
    is_long = F.length(F.array_join(words, " ")) >= longest(contained)
    columns = {"__form": form, "__words": words, "__long": F.when(is_long, form)}
    return columns, [Slot(("__long",), any_block=True), Slot(("__form",), inside="__words", any_block=True)]


def _joined(parts: list[Column]) -> Column:
    """One text for several values; NULL if any is NULL."""
    filled = reduce(lambda a, b: a & b, [p.isNotNull() for p in parts])
    return F.when(filled, F.to_json(F.array(*[p.cast("string") for p in parts])))


# ---------------------------------------------------------------- scoring

def _both(attr: str) -> tuple[Column, Column]:
    return F.col(f"l.{attr}"), F.col(f"r.{attr}")


def _is_deterministic(spec: Matching) -> Column:
    keys = [reduce(lambda a, b: a & b, [_both(c)[0] == _both(c)[1] for c in key]) for key in spec.deterministic]
    return F.coalesce(reduce(lambda a, b: a | b, keys), F.lit(False)) if keys else F.lit(False)


def _conflict(spec: Matching) -> Column:
    clash = [_both(c)[0] != _both(c)[1] for c in spec.conflict_columns]
    return F.coalesce(reduce(lambda a, b: a | b, [F.coalesce(c, F.lit(False)) for c in clash]), F.lit(False)) \
        if clash else F.lit(False)


def _prepared(profile: DataFrame, spec: Matching) -> DataFrame:
    """Canonical text forms, once per profile instead of once per pair."""
    forms = {f"__{f.attribute}": sim.sorted_tokens(F.col(f.attribute)) if f.method == "token_sort_ratio"
             else sim.distinct_tokens(F.col(f.attribute)) for f in spec.features if f.method != "exact"}
    return profile.withColumns(forms)


def _exact_part(f) -> Column:
    a, b = _both(f.attribute)
    return F.coalesce(F.when(a == b, F.lit(1.0)), F.lit(0.0))


def _bound(spec: Matching, known: set[str], agreeing: Column | None = None) -> Column:
    """What a pair can score at most, when only the similarities in `known` were measured.

    `agreeing` is the most that exact features can add, for pairs of texts without them.
    """
    total = F.lit(0.0) if agreeing is None else agreeing
    for f in spec.features:
        if f.method == "exact" and agreeing is not None:
            continue
        forms = _both(f"__{f.attribute}")
        if f.attribute in known:
            part = F.col(f"sim_{f.attribute}")
        elif f.method == "exact":
            part = _exact_part(f)
        elif f.method == "token_sort_ratio":
            part = F.coalesce(sim.sort_ratio_bound(*forms), F.lit(0.0))
        else:
            part = F.when(forms[0].isNotNull() & forms[1].isNotNull(), F.lit(1.0)).otherwise(0.0)
        total = total + f.weight * part
    return total


def _measured(pairs: DataFrame, spec: Matching, floor: float, agreeing: Column | None = None) -> DataFrame:
    """Similarities of the texts; a NULL on either side contributes nothing.

    Features are measured by falling weight, and a pair leaves as soon as the
    rest cannot lift it to the floor.
    """
    known: set[str] = set()
    for f in sorted((f for f in spec.features if f.method != "exact"), key=lambda f: -f.weight):
        measured = F.coalesce(sim.ratio(f.method, *_both(f"__{f.attribute}")), F.lit(0.0))
        known = known | {f.attribute}
        pairs = pairs.withColumn(f"sim_{f.attribute}", measured).filter(_bound(spec, known, agreeing) >= floor - ROUNDING)
    return pairs


def _scored(pairs: DataFrame, spec: Matching, floor: float) -> DataFrame:
    """Weighted similarity, rounded to four digits."""
    return _totalled(_measured(pairs, spec, floor), spec, floor)


def _totalled(pairs: DataFrame, spec: Matching, floor: float) -> DataFrame:
    pairs = pairs.withColumns({f"sim_{f.attribute}": _exact_part(f) for f in spec.features if f.method == "exact"})
    total = reduce(lambda t, f: t + f.weight * F.col(f"sim_{f.attribute}"), spec.features, F.lit(0.0))
    return pairs.withColumn("score", F.round(total, 4)).filter(F.col("score") >= floor)


def _decided(score: Column, conflict: Column, spec: Matching) -> Column:
    return (F.when(conflict, REJECTED).when(score >= spec.auto_match, MATCH)
            .when(score >= spec.review, REVIEW).otherwise(NO_MATCH))


# ---------------------------------------------------------------- fuzzy pairs

def fuzzy_pairs(records: DataFrame, spec: Matching, floor: float | None = None,
                split_rows: int = SPLIT_ROWS) -> DataFrame:
    """Decisions on all non-deterministic pairs of profiles that share a block and score at least `floor`.

    `floor` defaults to the review threshold.  One row stands for
    `record_pairs` pairs of records with the same values; the uids are the
    first of either profile (first and last for copies within one profile).
    """
    floor = spec.review if floor is None else floor
    scored, copies = _fuzzy(_profile_table(records, spec, floor), spec, floor, split_rows)
    return copies if scored is None else scored.select(*PAIR_COLUMNS).unionByName(copies)


def pair_features(records: DataFrame, spec: Matching, floor: float | None = None, carried: tuple[str, ...] = (),
                  same: str | None = None) -> DataFrame:
    """The pairs of `fuzzy_pairs` between profiles with the similarity of each attribute (`sim_*`).

    Columns of the two named records in `carried` come along as `<column>_1` and
    `<column>_2`, so the pairs need not be joined back to them.  With `same`, `is_same` tells
    whether that column is filled and equal in both.
    """
    floor = spec.review if floor is None else floor
    if same is not None and _whole_blocks(_slots(spec, floor)[1]):
        return _block_pairs(_profile_table(records, spec, floor, (*carried, same)), spec, floor, SPLIT_ROWS, carried, same)
    both = carried if same is None else (*carried, same)
    scored, copies = _fuzzy(_profile_table(records, spec, floor, both), spec, floor, SPLIT_ROWS, both)
    if scored is None:
        sims = [F.lit(0.0).alias(f"sim_{f.attribute}") for f in spec.features]
        more = [F.lit(None).cast(records.schema[c].dataType).alias(f"{c}_{side}") for c in both for side in (1, 2)]
        scored = copies.filter(F.lit(False)).select(*PAIR_COLUMNS, *sims, *more)
    if same is not None:
        scored = scored.withColumn("is_same", F.coalesce(F.col(f"{same}_1") == F.col(f"{same}_2"), F.lit(False)))
        scored = scored.drop(*[f"{same}_{side}" for side in (1, 2) if same not in carried])
    return scored


def feature_counts(records: DataFrame, spec: Matching, floor: float, same: str, without: tuple[int, int], split_rows: int = SPLIT_ROWS) -> DataFrame:
    """(sim_*, is_same, pairs): the rows of `pair_features` counted by their similarities.

    Rows whose xxhash64(record_uid_1, record_uid_2) modulo the first of `without` is the second are left out.
    Where whole blocks meet, pairs are counted where they are scored and never listed.
    """
    if _whole_blocks(_slots(spec, floor)[1]):
        sides = _profile_sides(_profile_table(records, spec, floor, (same,)), spec).withColumnRenamed(f"__c_{same}", "__same")
        found = _tile_pairs(_entered(sides, split_rows), spec, floor, same=("__same",), counted="features", without=without)
        order = tiles.exact_columns(*_kernel(spec), ("__same",))
        listed = found.select(*_sims(spec, order), (F.col("equal").bitwiseAND(1 << order.index("__same")) > 0).alias("is_same"), F.col("n").alias("pairs"))
    else:
        pairs = pair_features(records, spec, floor, same=same)
        listed = pairs.filter(F.pmod(F.xxhash64("record_uid_1", "record_uid_2"), F.lit(without[0])) != without[1]).withColumn("pairs", F.lit(1))
    return listed.groupBy(*[f"sim_{f.attribute}" for f in spec.features], "is_same").agg(F.sum("pairs").alias("pairs"))


def _profile_table(records: DataFrame, spec: Matching, floor: float, carried: tuple[str, ...] = ()) -> DataFrame:
    """Profiles with their text forms, block keys and evidence, written once for all their readers."""
    return materialize(_prepared(profiles(records, spec, carried), spec).withColumns({
        **{f"__b{i}": F.expr(b.expr) for i, b in enumerate(spec.blocking)}, **_slots(spec, floor)[0]}), "profiles")


def _fuzzy(profile: DataFrame, spec: Matching, floor: float, split_rows: int,
           carried: tuple[str, ...] = ()) -> tuple[DataFrame | None, DataFrame]:
    """(pairs of different profiles or None if none can reach the floor, copies within profiles)."""
    slots = _slots(spec, floor)[1]
    if _whole_blocks(slots):
        across = _block_pairs(profile, spec, floor, split_rows, carried=carried)
    else:
        across = _cross_profile(profile, spec, slots, floor, split_rows, carried) if slots else None
    return across, _within_profile(profile, spec, floor)


def _whole_blocks(slots: list[Slot]) -> bool:
    """Does every pair of a block meet, because nothing else can be said about a pair that reaches the floor?"""
    return bool(slots) and all(s.any_block is False and not s.equal and s.inside is None for s in slots)


def _block_pairs(profile: DataFrame, spec: Matching, floor: float, split_rows: int, carried: tuple[str, ...] = (),
                 same: str | None = None) -> DataFrame:
    """Pairs of profiles that share a block and score `floor` or more, with the similarity of each attribute."""
    return _tiled_profiles(_entered(_profile_sides(profile, spec), split_rows), spec, floor, carried, same)


def _slot_pairs(profile: DataFrame, meeting: DataFrame, spec: Matching, slots: list[Slot], floor: float, split_rows: int,
                carried: tuple[str, ...]) -> DataFrame:
    """Pairs of the profiles of `meeting`, each taken in the first slot that both are in."""
    keys = [F.concat(F.lit(f"{n:03d}|"), _joined([F.col(k) for k in slot.keys])) for n, slot in enumerate(slots)]
    sides = profile.withColumns({"uid": F.col("first_uid"), "n": F.col("n_records"), "__blocks": F.array_compact(F.array(*keys))})
    entered = meeting.select("first_uid", "__slot", _tile_parts(split_rows).alias("__parts")).join(sides, "first_uid").withColumns({
        "__block": F.coalesce(*[F.when(F.col("__slot") == n, key) for n, key in enumerate(keys)]), "__asked": F.lit(True)})
    return _tiled_profiles(entered, spec, floor, carried)


def _tiled_profiles(entered: DataFrame, spec: Matching, floor: float, carried: tuple[str, ...], same: str | None = None) -> DataFrame:
    also = () if same is None else (f"__c_{same}",)
    found = _tile_pairs(entered, spec, floor, same=also, carried=tuple(f"__c_{c}" for c in carried))
    order = tiles.exact_columns(*_kernel(spec), also)
    return found.select(
        F.col("uid_1").alias("record_uid_1"), F.col("uid_2").alias("record_uid_2"), F.col("n").alias("record_pairs"), "score",
        F.lit("probabilistic").alias("method"), _decided(F.col("score"), F.col("differ") > 0, spec).alias("decision"),
        *_sims(spec, order), *[F.col(f"__c_{c}_{side}").alias(f"{c}_{side}") for c in carried for side in (1, 2)],
        *[(F.col("equal").bitwiseAND(1 << order.index(c)) > 0).alias("is_same") for c in also])


def _sims(spec: Matching, order: list[str]) -> list[Column]:
    """Similarities as columns: texts have theirs, exact features a bit of `equal`."""
    return [((F.col("equal").bitwiseAND(1 << order.index(f.attribute)) > 0).cast("double") if f.method == "exact"
             else F.col(f"sim_{f.attribute}")).alias(f"sim_{f.attribute}") for f in spec.features]


def score_counts(records: DataFrame, spec: Matching, floor: float, same: str, split_rows: int = SPLIT_ROWS) -> DataFrame:
    """(score, is_same, record_pairs): the pairs of `pair_features` counted by score and by whether the first records agree on `same`.

    Where whole blocks meet, pairs are counted where they are scored and never listed.
    """
    slots = _slots(spec, floor)[1]
    if _whole_blocks(slots):
        sides = _profile_sides(_profile_table(records, spec, floor, (same,)), spec).withColumnRenamed(f"__c_{same}", "__same")
        found = _tile_pairs(_entered(sides, split_rows), spec, floor, same=("__same",), counted="score")
        listed = found.select("score", (F.col("equal") > 0).alias("is_same"), F.col("n").alias("record_pairs"))
    else:
        one, other = F.col(f"{same}_1"), F.col(f"{same}_2")
        listed = pair_features(records, spec, floor, (same,)).select("score", F.coalesce(one == other, F.lit(False)).alias("is_same"), "record_pairs")
    return listed.groupBy("score", "is_same").agg(F.sum("record_pairs").alias("record_pairs"))


def _kernel(spec: Matching) -> tuple[list[tuple[str, str, float]], list[tuple[str, ...]], tuple[str, ...]]:
    return [(f.attribute, f.method, f.weight) for f in spec.features], [tuple(k) for k in spec.deterministic], tuple(spec.conflict_columns)


def _profile_sides(profile: DataFrame, spec: Matching) -> DataFrame:
    """Profiles with the blocks they are in; a pair is taken in the first block, in the order of the spec."""
    named = [F.concat(F.lit(f"{i:03d}|"), F.col(f"__b{i}")) for i in range(len(spec.blocking))]
    return profile.withColumns({"uid": F.col("first_uid"), "n": F.col("n_records"), "__blocks": F.array_compact(F.array(*named))})


def _entered(sides: DataFrame, split_rows: int, asked: str | None = None) -> DataFrame:
    """A row per record and block with somebody to meet (somebody marked `asked`, if given), with the number of parts of the block."""
    marked = F.coalesce(F.col(asked), F.lit(False)) if asked else F.lit(True)
    entry = sides.withColumn("__asked", marked).select("*", F.explode("__blocks").alias("__block"))
    groups = (entry.groupBy("__block").agg(F.count("*").alias("__rows"), F.count_if("__asked").alias("__asking"))
              .filter("__rows > 1 AND __asking > 0").select("__block", _tile_parts(split_rows).alias("__parts")))
    return entry.join(groups, "__block")


def _tile_parts(split_rows: int) -> Column:
    return F.ceil(F.col("__rows") / min(split_rows, TILE_SIDE)).cast("int")


def _tile_pairs(entered: DataFrame, spec: Matching, floor: float, asked: bool = False, same: tuple[str, ...] = (), carried: tuple[str, ...] = (),
                sure_pairs: bool = False, counted: str | None = None, without: tuple[int, int] | None = None) -> DataFrame:
    """The pairs of all blocks, or with `asked` those with a row that is, scored tile by tile (`tiles.make_tiles`).

    A block of n rows has s = ceil(n / `TILE_SIDE`) parts, or more by `split_rows`, and a tile holds two of them: each pair of parts once, or, if
    rows are asked for, the asked ones of either part with all of the other.
    """
    features, keys, guarded = _kernel(spec)
    exact = tiles.exact_columns(features, keys, guarded, same)
    texts = [f"__{f.attribute}" for f in spec.features if f.method != "exact"]
    entered = entered.select(*dict.fromkeys(["uid", "n", "__blocks", *texts, *exact, *carried]), "__asked", "__block", "__parts")
    part = F.pmod(F.xxhash64("uid"), F.col("__parts")).cast("int")
    every = F.sequence(F.lit(0), F.col("__parts") - 1)

    def place(row: Column, column: Column, side: Column) -> Column:
        return F.struct(row.cast("int").alias("__row"), column.cast("int").alias("__tile"), side.cast("int").alias("__side"))

    if asked:
        mine = F.transform(every, lambda q: place(F.col("__part"), q, F.when(q == F.col("__part"), tiles.BOTH).otherwise(tiles.LEFT)))
        theirs = F.transform(every, lambda p: place(p, F.col("__part"), F.lit(tiles.RIGHT)))
        places = F.when(F.col("__asked"), F.concat(mine, F.filter(theirs, lambda x: x["__row"] != F.col("__part")))).otherwise(theirs)
        once = F.col("__asked")
    else:
        places = F.transform(every, lambda q: place(F.least(q, "__part"), F.greatest(q, "__part"), F.when(q == F.col("__part"), tiles.BOTH)
                                                    .when(F.col("__part") < q, tiles.LEFT).otherwise(tiles.RIGHT)))
        once = F.col("__row") == F.col("__tile")
    placed = entered.withColumn("__part", part).select("*", F.inline(places)).withColumn("__once", once)
    # As in `_squares`, asking for the number keeps it: the work of a task grows with pairs, not bytes.
    n = int(entered.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = placed.drop("__parts", "__part", "__asked").repartition(n, "__block", "__row", "__tile").sortWithinPartitions("__block", "__row", "__tile")
    kernel = tiles.make_tiles(features, keys, guarded, floor, same, carried, sure_pairs, counted, without)
    types = {c: entered.schema[c].dataType.simpleString() for c in carried}
    sims = [f"`sim_{f.attribute}` double" for f in spec.features if f.method != "exact"]
    if counted:
        return rows.mapInArrow(kernel, ", ".join([*(["score double"] if counted == "score" else sims), "equal int", "n long"]))
    return rows.mapInArrow(kernel, ", ".join([
        "uid_1 string", "uid_2 string", "n long", "score double", *sims, "equal int", "differ int",
        *[f"`{c}_{side}` {types[c]}" for c in carried for side in (1, 2)]]))


LEFT, RIGHT, BOTH = 1, 2, 3


def _entries(n: int, slot: Slot) -> Column:
    """The join groups a profile enters through one slot: (slot, group, side)."""
    def entry(side: int, *more: Column) -> Column:
        return F.struct(F.lit(n).alias("__slot"), F.xxhash64(F.lit(n), *[F.col(k) for k in slot.keys], *more).alias("__group"),
                        F.lit(side).alias("__side"))

    filled = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in slot.keys])
    if slot.inside is None:
        return F.when(filled, F.array(entry(BOTH))).otherwise(F.array())
    # If all my tokens are among yours, so is my smallest one: I ask under that one, you answer under each.
    words = F.col(slot.inside)
    asked = F.array(entry(LEFT, F.array_min(words)))
    answers = F.transform(words, lambda w: entry(RIGHT, w))
    return F.when(filled & (F.size(words) > 0), F.concat(asked, answers)).otherwise(F.array())


def slot_entries(records: DataFrame, spec: Matching, floor: float) -> DataFrame:
    """(slot, record_uid): hashed values under which a record meets every other that may score `floor` with it.

    Two records that can reach the floor without a key share at least one slot.
    """
    columns, slots = _slots(spec, floor)
    blocks = {f"__b{i}": F.expr(b.expr) for i, b in enumerate(spec.blocking)}
    # Column names of the slots are the only ones read besides the compared ones.
    formed = records.select("record_uid", *spec.columns).withColumns({**blocks, **columns})
    every = F.concat(*[_entries(n, slot) for n, slot in enumerate(slots)])
    return formed.select(F.explode(F.array_distinct(F.transform(every, lambda e: e["__group"]))).alias("slot"), "record_uid")


def _meets(spec: Matching, slot: Slot) -> Column:
    """Do two profiles belong together in a slot?  Compares values, so hashed groups stay exact."""
    same = reduce(lambda a, b: a & b, [_both(k)[0] == _both(k)[1] for k in slot.keys])
    if slot.inside:
        a, b = _both(slot.inside)
        same = same & ((F.size(F.array_except(a, b)) == 0) | (F.size(F.array_except(b, a)) == 0))
    if slot.any_block:
        shared = [F.coalesce(F.col(f"l.__b{i}") == F.col(f"r.__b{i}"), F.lit(False)) for i in range(len(spec.blocking))]
        same = same & reduce(lambda a, b: a | b, shared)
    return same


def _cross_profile(profile: DataFrame, spec: Matching, slots: list[Slot], floor: float, split_rows: int,
                   carried: tuple[str, ...] = ()) -> DataFrame:
    entries = profile.select("first_uid", _texts(spec).alias("__text"),
                             F.inline(F.concat(*[_entries(n, slot) for n, slot in enumerate(slots)])))
    meeting = _meeting(entries, split_rows)
    recurring = _recurring(meeting, split_rows)
    once = all(f.method == "exact" for f in spec.features) or recurring.isEmpty()
    direct = meeting if once else meeting.join(recurring, "__group", "left_anti")
    # Slots of equal values alone come first, so no other takes a pair of theirs.
    plain = list(takewhile(lambda slot: not slot.inside and not slot.any_block, slots))
    is_large = (F.col("__rows") >= TILE_ROWS) & (F.col("__slot") < len(plain))
    large = None if meeting.filter(is_large).isEmpty() else direct.filter(is_large)
    direct = direct if large is None else direct.filter(~is_large)
    left, right = _tiles(profile, direct.drop("__text", "__rows"))
    on = [F.col(f"l.{c}") == F.col(f"r.{c}") for c in ("__group", "__row", "__tile", "__slot")]
    # Each pair is taken in one orientation: by uid, or the contained side first.
    by_uid = F.col("l.first_uid") < F.col("r.first_uid")
    for n, slot in enumerate(slots):
        if slot.inside:
            a, b = (F.size(c) for c in _both(slot.inside))
            smaller = (a < b) | ((a == b) & by_uid)
            by_uid = F.when(F.col("l.__slot") == n, smaller).otherwise(by_uid)
    # Profiles meeting in several slots are taken in the first of them: no distinct over pairs.
    first = F.coalesce(*[F.when(_meets(spec, slot), F.lit(n)) for n, slot in enumerate(slots)])
    taken = [~_is_deterministic(spec), first == F.col("l.__slot")]
    on += [by_uid, *taken, _bound(spec, set()) >= floor - ROUNDING]
    met = left.alias("l").join(right.alias("r"), reduce(lambda a, b: a & b, on))
    named = _named_pairs(_scored(met, spec, floor), spec, carried)
    if large is not None:
        named = named.unionByName(_slot_pairs(profile, large, spec, plain, floor, split_rows, carried))
    if once:
        return named
    by_text = _by_text(profile, meeting.join(recurring, "__group"), spec, slots, floor, taken)
    return named.unionByName(_named_pairs(by_text, spec, carried))


def _texts(spec: Matching) -> Column:
    return F.xxhash64(*[F.col(f"__{f.attribute}") for f in spec.features if f.method != "exact"] or [F.lit(0)])


def _recurring(meeting: DataFrame, split_rows: int) -> DataFrame:
    """(group, parts of its texts): groups whose texts recur, so that pairs of texts are far fewer than pairs of profiles."""
    # Groups asked from one side hold a profile under many tokens; they meet as they are.
    whole = meeting.filter((F.col("__rows") >= RECURRING_ROWS) & (F.col("__side") == BOTH))
    texts = whole.groupBy("__group", "__text").agg(F.count("*").alias("n")).groupBy("__group").agg(
        F.sum("n").alias("n"), F.count("*").alias("texts"))
    return materialize(texts.filter("texts * 2 <= n").select(
        "__group", F.ceil(F.col("texts") / split_rows).cast("int").alias("__text_parts")), "recurring")


def _agreeing_at_most(spec: Matching, slots: list[Slot], n: int) -> float:
    """The most that exact features can add to a pair taken in slot `n`: an earlier slot would have taken it otherwise."""
    exact = {f.attribute: f.weight for f in spec.features if f.method == "exact"}
    earlier = [set(s.equal) for s in slots[:n] if s.settled]
    return max((sum(exact[a] for a in s) for s in _subsets(exact)
                if set(slots[n].equal) <= set(s) and not any(e <= set(s) for e in earlier)), default=0.0)


def _by_text(profile: DataFrame, meeting: DataFrame, spec: Matching, slots: list[Slot], floor: float, taken: list[Column]) -> DataFrame:
    """Pairs of groups with recurring texts: texts are measured once per group, then the profiles of the texts that are close meet."""
    fuzzy = [f"__{f.attribute}" for f in spec.features if f.method != "exact"]
    forms = F.struct(*fuzzy)
    members = materialize(meeting.select("first_uid", "__slot", "__group", "__text_parts").join(profile, "first_uid"), "members")
    texts = members.select("__slot", "__group", F.col("__text_parts").alias("__parts"), *fuzzy).distinct().withColumn("__forms", forms)
    left, right = _squares(texts, texts, "__forms", "__group")
    on = [F.col(f"l.{c}") == F.col(f"r.{c}") for c in ("__group", "__row", "__tile", "__slot")]
    agreeing = F.coalesce(*[F.when(F.col("l.__slot") == n, F.lit(float(_agreeing_at_most(spec, slots, n)))) for n in range(len(slots))])
    # Sums of weights differ in their last bits with the order of the features; the exact score follows below.
    low = floor - ROUNDING
    on += [F.col("l.__forms") <= F.col("r.__forms"), _bound(spec, set(), agreeing) >= low - ROUNDING]
    close = _measured(left.alias("l").join(right.alias("r"), reduce(lambda a, b: a & b, on)), spec, low, agreeing).select(
        F.col("l.__slot").alias("slot"), F.col("l.__group").alias("group"), F.col("l.__forms").alias("one"), F.col("r.__forms").alias("other"),
        *[f"sim_{f.removeprefix('__')}" for f in fuzzy])
    close = materialize(close, "close_texts")
    sides = members.withColumn("__forms", forms)
    n = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def of(side: str, text: str) -> Column:
        keys = zip((f"{side}.__slot", f"{side}.__group", f"{side}.__forms"), ("slot", "group", text))
        return reduce(lambda a, b: a & b, [F.col(mine) == F.col(yours) for mine, yours in keys])

    # As in `_squares`, asking for the number keeps it: few rows make many pairs here.
    begun = close.join(sides.alias("l"), of("l", "one")).repartition(n, "slot", "group", "other")
    apart = (F.col("one") != F.col("other")) | (F.col("l.first_uid") < F.col("r.first_uid"))
    pairs = begun.join(sides.repartition(n, "__slot", "__group", "__forms").alias("r"), reduce(lambda a, b: a & b, [of("r", "other"), apart, *taken]))
    return _totalled(pairs, spec, floor)


def _named_pairs(scored: DataFrame, spec: Matching, carried: tuple[str, ...]) -> DataFrame:
    a, b = _both("first_uid")
    return scored.select(
        F.least(a, b).alias("record_uid_1"), F.greatest(a, b).alias("record_uid_2"),
        (F.col("l.n_records") * F.col("r.n_records")).alias("record_pairs"), "score",
        F.lit("probabilistic").alias("method"), _decided(F.col("score"), _conflict(spec), spec).alias("decision"),
        *[f"sim_{f.attribute}" for f in spec.features],
        *[F.when(a < b, F.col(f"{one}.__c_{c}")).otherwise(F.col(f"{other}.__c_{c}")).alias(f"{c}_{side}")
          for c in carried for side, one, other in ((1, "l", "r"), (2, "r", "l"))])


def _meeting(entries: DataFrame, split_rows: int) -> DataFrame:
    """Entries of groups in which somebody meets somebody else, with the number of parts of their group.

    Most values are unique, so this narrow pass (ids and hashes only) leaves
    few rows for the wide one that carries the compared texts.
    """
    side = F.col("__side")
    n = {s: F.count_if(side == s) for s in (LEFT, RIGHT, BOTH)}
    # Whoever asks under a token also answers under it.
    alive = (n[BOTH] > 1) | ((n[LEFT] > 0) & (n[RIGHT] > 1))
    groups = entries.groupBy("__group").agg(
        alive.alias("alive"), F.count("*").alias("__rows"), F.ceil(F.count("*") / split_rows).cast("int").alias("__parts")).filter("alive").drop("alive")
    return materialize(entries.join(groups, "__group"), "meeting")


def _tiles(profile: DataFrame, meeting: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both join sides, with hot groups cut into a square of tiles.

    A group of n rows has s = ceil(n / split_rows) parts; left part p meets
    right part q in tile (p, q), so every pair of the group is met once per
    orientation and no task holds more than two parts.  Other groups are a
    single tile.
    """
    sides = [meeting.filter(F.col("__side") != out).join(profile, "first_uid") for out in (RIGHT, LEFT)]
    return _squares(*sides, "first_uid", "__group")


def _squares(left: DataFrame, right: DataFrame, uid: str, group: str) -> tuple[DataFrame, DataFrame]:
    """`__row` and `__tile` for both sides of a join on `group`, by its number of `__parts`."""
    part = F.pmod(F.xxhash64(uid), F.col("__parts")).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.col("__parts") - 1))
    left = left.withColumn("__row", part).select("*", every.alias("__tile"))
    right = right.withColumn("__tile", part).select("*", every.alias("__row"))
    # The join needs this partitioning anyway.  Asking for the number keeps it: the work of a task
    # grows with pairs, not bytes, so partitions that look small must not be merged.
    n = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return left.repartition(n, group, "__row", "__tile"), right.repartition(n, group, "__row", "__tile")


def _within_profile(profile: DataFrame, spec: Matching, floor: float) -> DataFrame:
    """Copies inside one profile: they agree wherever there is a value."""
    sure = [reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in key]) for key in spec.deterministic]
    deterministic = reduce(lambda a, b: a | b, sure) if sure else F.lit(False)
    blocked = reduce(lambda a, b: a | b, [F.expr(b.expr).isNotNull() for b in spec.blocking])
    total = F.lit(0.0)
    for f in spec.features:
        part = F.when(F.col(f.attribute).isNotNull(), F.lit(f.weight))
        if f.method == "token_set_ratio":  # no token at all: nothing in common
            part = F.when(F.length(f"__{f.attribute}") > 0, F.lit(f.weight))
        total = total + F.coalesce(part, F.lit(0.0))
    n = F.col("n_records")
    return (profile.filter((n > 1) & blocked & ~deterministic).withColumn("score", F.round(total, 4))
            .filter(F.col("score") >= floor)
            .select(F.col("first_uid").alias("record_uid_1"), F.col("last_uid").alias("record_uid_2"),
                    F.expr("n_records * (n_records - 1) div 2").alias("record_pairs"), "score",
                    F.lit("probabilistic").alias("method"),
                    _decided(F.col("score"), F.lit(False), spec).alias("decision")))


def deterministic_decisions(records: DataFrame, spec: Matching, links: DataFrame | None = None) -> DataFrame:
    """Key links in the shape of the decision table (score 1)."""
    return (deterministic_links(records, spec) if links is None else links).select(
        F.col("record_uid").alias("record_uid_1"), F.col("root_uid").alias("record_uid_2"),
        F.lit(1).cast("bigint").alias("record_pairs"), F.lit(1.0).alias("score"),
        F.lit("deterministic").alias("method"), F.lit(MATCH).alias("decision")).distinct()


def match_pairs(records: DataFrame, spec: Matching, floor: float | None = None, links: DataFrame | None = None) -> DataFrame:
    """The decision table: deterministic links (score 1; `links`, if already made) and every fuzzy pair at or above `floor`."""
    return deterministic_decisions(records, spec, links).unionByName(fuzzy_pairs(records, spec, floor))


def compared_pairs(records: DataFrame, wanted: DataFrame, spec: Matching, split_rows: int = SPLIT_ROWS) -> DataFrame:
    """Every compared pair with a record in `wanted` (record_uid), also the low-scoring and rejected ones, record by record.

    (record_uid_1, record_uid_2, score, method, decision, conflicts).  The work is
    that of the wanted records' blocks: their members meet the others there, the
    others do not meet each other.  A pair that shares several blocks is taken in the
    first of them.  Records enter their blocks with their texts and large blocks are
    cut into tiles, so a pair is scored where it is formed and never moved.
    """
    blocks = F.array_sort(F.array_distinct(F.array_compact(F.array(*[F.expr(b.expr) for b in spec.blocking]))))
    sides = _prepared(records.select("record_uid", *spec.columns), spec).withColumns({
        "uid": F.col("record_uid"), "n": F.lit(1).cast("bigint"), "__blocks": blocks})
    marked = wanted.select("record_uid").distinct().withColumn("is_wanted", F.lit(True))
    asked = materialize(sides.join(marked, "record_uid", "left"), "asked")
    found = _tile_pairs(_entered(asked, split_rows, "is_wanted"), spec, 0.0, asked=True, sure_pairs=True)
    order = tiles.exact_columns(*_kernel(spec))
    named = F.concat_ws("+", *[F.when(F.col("differ").bitwiseAND(1 << order.index(c)) > 0, F.lit(c)) for c in spec.conflict_columns])
    if len(spec.conflict_columns) <= 4:  # few ways to differ: their names are made once
        ways = [(sum(1 << order.index(c) for c in s), "+".join(s)) for s in _subsets(dict.fromkeys(spec.conflict_columns))]
        named = F.coalesce(*[F.when(F.col("differ") == bits, F.lit(name)) for bits, name in ways])

    def holds(key: tuple[str, ...]) -> Column:
        bits = sum(1 << order.index(c) for c in dict.fromkeys(key))
        return F.col("equal").bitwiseAND(bits) == bits

    sure = reduce(lambda a, b: a | b, [holds(k) for k in spec.deterministic], F.lit(False))
    return found.select(
        F.col("uid_1").alias("record_uid_1"), F.col("uid_2").alias("record_uid_2"), "score",
        F.when(sure, F.lit("deterministic")).otherwise(F.lit("probabilistic")).alias("method"),
        F.when(sure, F.lit(MATCH)).otherwise(_decided(F.col("score"), F.col("differ") > 0, spec)).alias("decision"), named.alias("conflicts"))


def review_members(pairs: DataFrame, stands: DataFrame) -> DataFrame:
    """(record_uid_1, record_uid_2, score, record_uid): all records that a pair for review stands for, its copies included."""
    queue = pairs.filter((F.col("decision") == REVIEW) & (F.col("method") == "probabilistic"))
    # A pair within one profile names its first and last record; both lead to that profile.
    ends = queue.select("record_uid_1", "record_uid_2", "score", F.explode(F.array("record_uid_1", "record_uid_2")).alias("end"))
    firsts = ends.join(stands.withColumnRenamed("record_uid", "end"), "end").drop("end").distinct()
    return firsts.join(stands, "first_uid").select("record_uid_1", "record_uid_2", "score", "record_uid")


def review_queue(pairs: DataFrame, limit: int | None = None) -> DataFrame:
    """Pairs for the steward, best first; `limit` gives the top of the queue without a full sort."""
    queue = pairs.filter(F.col("decision") == REVIEW).orderBy(F.desc("score"), "record_uid_1", "record_uid_2")
    return queue if limit is None else queue.limit(limit)


# ---------------------------------------------------------------- clustering

def match_edges(records: DataFrame, spec: Matching, links: DataFrame | None = None) -> DataFrame:
    """(src, dst) whose components are the entities.

    If no fuzzy pair can reach the automatic threshold (decidable from the
    weights alone), key links are all there is and nothing is scored.
    """
    links = deterministic_links(records, spec) if links is None else links
    edges = links.select(F.col("record_uid").alias("src"), F.col("root_uid").alias("dst"))
    if reachable_evidence(spec, spec.auto_match) is None:
        return edges
    certain = (materialize(fuzzy_pairs(records, spec, spec.auto_match), "fuzzy").filter(F.col("decision") == MATCH)
               .select(F.col("record_uid_1").alias("src"), F.col("record_uid_2").alias("dst")))
    # A matched profile stands for all its records.
    stands = certain.select(F.explode(F.array("src", "dst")).alias("first_uid")).distinct()
    copies = (profile_members(records, spec).filter("record_uid != first_uid").join(stands, "first_uid", "left_semi")
              .select(F.col("record_uid").alias("src"), F.col("first_uid").alias("dst")))
    return edges.unionByName(certain).unionByName(copies)


def clusters(records: DataFrame, spec: Matching, id_length: int = 32, links: DataFrame | None = None) -> DataFrame:
    """(record_uid, cluster_id, root_uid) for every record; singletons keep their own uid.

    The root is the largest uid of the component, so ids do not depend on the
    order in which pairs are found.
    """
    found = connected_components(match_edges(records, spec, links)).withColumnRenamed("vertex", "record_uid")
    return label(records.select("record_uid").join(found, "record_uid", "left")
                 .select("record_uid", F.coalesce("component", "record_uid").alias("root_uid")), id_length)


def label(rooted: DataFrame, id_length: int = 32) -> DataFrame:
    return rooted.select("record_uid", cluster_name(F.col("root_uid"), id_length).alias("cluster_id"), "root_uid")


def cluster_name(root: Column, id_length: int = 32) -> Column:
    return F.concat(F.lit("E-"), F.substring(root, 1, id_length))


def cluster_conflicts(members: DataFrame, spec: Matching) -> DataFrame:
    """Clusters joining records that differ on a guarded column (through keys or transitivity)."""
    # min and max tell "more than one value" without a distinct aggregation per column
    spread = [(F.min(c) != F.max(c)).alias(f"{c}_differs") for c in spec.conflict_columns]
    differs = reduce(lambda a, b: a | b, [F.col(f"{c}_differs") for c in spec.conflict_columns])
    return members.groupBy("cluster_id").agg(F.count("*").alias("n_records"), *spread).filter(F.coalesce(differs, F.lit(False)))


# ---------------------------------------------------------------- exact counts without pairs

def _agreeing(weighted: DataFrame, sets: list[tuple[int, str, list[Column]]], conflict: tuple[str, ...]) -> DataFrame:
    """(tag, pairs, conflicts): signed numbers of pairs agreeing on each set of columns.

    Rows of `weighted` stand for `n_records` records each.  Only group sizes are used: C(n,2) per group.  Pairs that conflict on every
    column of a subset are those with all of them filled, less those equal on
    some of them (inclusion-exclusion), so the sizes per guarded value are
    needed too; one grouping-sets aggregation gives them all.
    """
    entries = F.array_compact(F.array(*[
        F.when(_joined(cols).isNotNull(),
               F.struct(F.lit(n).alias("set"), F.unhex(F.sha2(_joined(cols), 256)).alias("key")))
        for n, (_, _, cols) in enumerate(sets)
    ]))
    cells = (weighted.select("n_records", *conflict, F.inline(entries)).groupBy("set", "key", *conflict)
             .agg(F.sum("n_records").alias("n")))
    subsets = list(_subsets(conflict))

    def filled(chosen) -> Column:
        return F.sum(reduce(lambda n, c: F.when(F.col(c).isNotNull(), n), chosen, F.col("n")))

    sizes = cells.groupingSets([["set", "key", *s] for s in subsets], "set", "key", *conflict).agg(
        *[filled(s).alias(f"n{i}") for i, s in enumerate(subsets)],
        *[F.grouping(c).alias(f"open_{c}") for c in conflict])
    # A grouping set counts pairs equal on its columns: it enters for every subset that contains them.
    equal_on = {s: reduce(lambda a, c: a & (F.col(f"open_{c}") == (0 if c in s else 1)), conflict, F.lit(True))
                for s in subsets}
    zero = F.lit(0).cast("decimal(38,0)")
    pairs = F.when(equal_on[()], _pairs_of("n0")).otherwise(zero)
    clashes = zero
    for s in subsets:
        for i, chosen in enumerate(subsets):
            if chosen and set(s) <= set(chosen):
                sign = (1 if len(chosen) % 2 else -1) * (-1) ** len(s)
                clashes = clashes + F.when(equal_on[s], F.coalesce(_pairs_of(f"n{i}"), zero) * sign).otherwise(zero)
    number = F.col("set")
    sign = F.coalesce(*[F.when(number == n, F.lit(sign)) for n, (sign, _, _) in enumerate(sets)])
    tag = F.coalesce(*[F.when(number == n, F.lit(tag)) for n, (_, tag, _) in enumerate(sets)])
    per_set = sizes.groupBy("set").agg(F.sum(pairs.cast("decimal(38,0)")).alias("pairs"),
                                       F.sum(clashes.cast("decimal(38,0)")).alias("conflicts"))
    return per_set.groupBy(tag.alias("tag")).agg(
        *[F.sum((F.col(k) * sign).cast("decimal(38,0)")).cast("decimal(38,0)").alias(k) for k in ("pairs", "conflicts")])


def _union_sets(tag: str, keys: list[list[Column]]) -> list[tuple[int, str, list[Column]]]:
    """Inclusion-exclusion: pairs agreeing on at least one of the keys."""
    return [(1 if len(s) % 2 else -1, tag, list(chain.from_iterable(s))) for s in _subsets(keys) if s]


def _blocked_sets(spec: Matching) -> list[tuple[int, str, list[Column]]]:
    return _union_sets("candidate", [[F.expr(b.expr)] for b in spec.blocking])


def candidate_pair_count(records: DataFrame, spec: Matching) -> DataFrame:
    """Distinct pairs sharing at least one block, from block sizes alone."""
    single = records.withColumn("n_records", F.lit(1).cast("bigint"))
    counted = _agreeing(single, _blocked_sets(spec), ()).groupBy().agg(F.sum("pairs").alias("n"))
    return counted.select(F.coalesce("n", F.lit(0)).cast("decimal(38,0)").alias("candidate_pairs"))


def _sure_sets(spec: Matching) -> list[tuple[int, str, list[Column]]]:
    """Compared pairs that a key decides."""
    blocks = [[F.expr(b.expr)] for b in spec.blocking]
    keys = [[F.col(c) for c in k] for k in spec.deterministic]
    if all(_implied(spec, k) for k in spec.deterministic):
        return _union_sets("deterministic", keys)
    return [(s1 * s2, "deterministic", c1 + c2) for s1, _, c1 in _union_sets("", keys)
            for s2, _, c2 in _union_sets("", blocks)]


def open_pair_count(records: DataFrame, spec: Matching, entity: str | None = None) -> DataFrame:
    """`open_pairs`: compared pairs that no key decides, from group sizes; with `entity` those of one entity only."""
    more = [F.col(entity)] if entity else []
    sets = [(sign, tag, columns + more) for sign, tag, columns in _blocked_sets(spec) + _sure_sets(spec)]
    single = records.withColumn("n_records", F.lit(1).cast("bigint"))
    part = F.when(F.col("tag") == "candidate", F.col("pairs")).otherwise(-F.col("pairs"))
    return _agreeing(single, sets, ()).agg(F.coalesce(F.sum(part), F.lit(0)).cast("bigint").alias("open_pairs"))


def match_bands(records: DataFrame, spec: Matching) -> DataFrame:
    """(decision, method, record_pairs) over all compared pairs, without forming the low-scoring ones."""
    profile = _profile_table(records, spec, spec.review)
    counted = _agreeing(profile, _blocked_sets(spec) + _sure_sets(spec), spec.conflict_columns)
    across, copies = _fuzzy(profile, spec, spec.review, SPLIT_ROWS)
    above = copies if across is None else across.select(*PAIR_COLUMNS).unionByName(copies)
    fuzzy = (above.groupBy(F.col("decision").alias("tag"))
             .agg(F.sum("record_pairs").cast("decimal(38,0)").alias("pairs"))
             .withColumn("conflicts", F.lit(0).cast("decimal(38,0)")))

    def total(tag: str, kind: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("tag") == tag, F.col(kind))), F.lit(0))

    sums = counted.unionByName(fuzzy).groupBy().agg(
        total("candidate", "pairs").alias("candidates"), total("deterministic", "pairs").alias("sure"),
        (total("candidate", "conflicts") - total("deterministic", "conflicts")).alias("rejected"),
        total(MATCH, "pairs").alias("matched"), total(REVIEW, "pairs").alias("review"))
    rest = reduce(lambda a, c: a - F.col(c), ["sure", "matched", "review", "rejected"], F.col("candidates"))
    bands = [(MATCH, "deterministic", F.col("sure")), (MATCH, "probabilistic", F.col("matched")),
             (REVIEW, "probabilistic", F.col("review")), (REJECTED, "probabilistic", F.col("rejected")),
             (NO_MATCH, "probabilistic", rest)]
    return sums.select(F.inline(F.array(*[
        F.struct(F.lit(d).alias("decision"), F.lit(m).alias("method"), n.cast("decimal(38,0)").alias("record_pairs"))
        for d, m, n in bands])))
