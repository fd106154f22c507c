"""Mixing sources to target weights as a time-varying curriculum (DataFrame functions only).

Every source has a weight and a schedule: its rate of use over training time ``t`` in [0, 1],
linear between knots. The share of all words that a source gets is fixed by its weight
(water-filling under a cap on repeats); its schedule says *when* they are used. Integrating the
schedule gives the source's cumulative demand, and inverting that at the cumulative words before
a document gives the document's training position.

Documents of a source are laid on a ring in the order of ``md5(doc_id)``. Cumulative words come
from a two-level prefix sum: sums per (source, digest prefix), a running total of those few sums,
then a running total inside each (source, prefix). No window spans a whole source, so a source
that holds most rows is still dealt over ``16 ** prefix`` tasks; the prefix grows with the rows.
Rows are in one fixed order (digest of the id, id, digest of the text), whatever their ids, so reruns agree.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Words are maximal runs of anything but space, tab, LF, VT, FF and CR.
_SPACES = "\t\n\x0b\x0c\r"

#: Rate of use over time by weight class: (t, rate) knots. Heavy sources start strong and fade.
SCHEDULES = (
    ((0.0, 1.5), (1.0, 0.5)),
    ((0.0, 1.0), (1.0, 1.0)),
    ((0.0, 0.5), (1.0, 1.5)),
)


#: Digits of the digest that deal a source out at least, and rows that a window holds on average at most.
LEAST_PREFIX, WINDOW_ROWS = 3, 50_000


def word_count(text: Column) -> Column:
    """Number of runs of non-space characters; 0 for null."""
    flat = F.translate(text, _SPACES, " " * len(_SPACES))
    return F.coalesce(F.size(F.filter(F.split(flat, " "), lambda w: w != "")), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[float], share: float, cap: float) -> DataFrame:
    """Words to take per source: (source, source_size, w_class, target).

    ``sizes`` has one row per source (source, source_size). Weights repeat over the sources in
    code-point order, null last. ``share`` of all words is split by weight; no source gets more
    than ``cap`` times its size, and the excess goes to the others by weight. Sorted by
    size/weight, the capped sources are a prefix, so one running sum finds the final level.
    The windows here are over one row per source.
    """
    everything = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.array(*[F.lit(float(w)) for w in weights])
    ranked = sizes.withColumn("w_class", (F.row_number().over(everything) - 1) % len(weights)).withColumn(
        "weight", F.element_at(weight, F.col("w_class") + 1)
    )
    ranked = ranked.withColumn("ratio", F.lit(float(cap)) * F.col("source_size") / F.col("weight"))
    up = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    before = up.rowsBetween(Window.unboundedPreceding, -1)
    whole = up.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (
        F.lit(float(share)) * F.sum("source_size").over(whole)
        - F.coalesce(F.sum(F.lit(float(cap)) * F.col("source_size")).over(before), F.lit(0.0))
    ) / (F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    levels = ranked.withColumn("level", level)
    final = F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "source", "level"))).over(whole)
    target = F.least(
        F.coalesce(F.col("weight") * final["level"], F.lit(float(cap)) * F.col("source_size")),
        F.lit(float(cap)) * F.col("source_size"),
    )
    return levels.select("source", "source_size", "w_class", target.alias("target"))


def demand_time(done: Column, schedule: Sequence[tuple[float, float]]) -> Column:
    """Time at which a share ``done`` (0..1) of a source's demand is met.

    The demand is the integral of the piecewise-linear schedule, scaled to 1; on each piece the
    inverse is the root of a quadratic (written so that it also holds for flat pieces).
    """
    areas = [(t1 - t0) * (r0 + r1) / 2 for (t0, r0), (t1, r1) in zip(schedule, schedule[1:], strict=False)]
    total, reached, out = sum(areas), 0.0, None
    pieces = []
    for ((t0, r0), (t1, r1)), area in zip(zip(schedule, schedule[1:], strict=False), areas, strict=True):
        rest = F.greatest(done * total - reached, F.lit(0.0))
        slope = (r1 - r0) / (t1 - t0)
        root = F.sqrt(F.greatest(F.lit(r0 * r0) + 2 * slope * rest, F.lit(0.0)))
        time = F.lit(t0) + F.when(F.lit(r0) + root > 0, 2 * rest / (F.lit(r0) + root)).otherwise(F.lit(0.0))
        reached += area
        pieces.append((reached / total, F.least(time, F.lit(t1))))
    for bound, time in reversed(pieces):
        out = time if out is None else F.when(done < bound, time).otherwise(out)
    return out


def _times(schedule: Sequence[tuple[float, float]]) -> Column:
    return F.transform("uses", lambda u: demand_time(u["at"] / F.col("goal"), schedule))


def mix(
    docs: DataFrame,
    weights: Sequence[float] = (5.0, 2.0, 1.0),
    share: float = 1.5,
    cap: float = 2.0,
    schedules: Sequence[Sequence[tuple[float, float]]] = SCHEDULES,
    prefix: int | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """What the mix takes of every document and when.

    Returns one row per row of ``docs`` (doc_id, text, source): doc_id, source, the columns in
    ``keep`` (as one struct, ``kept``), size, source_size, target, taken (words, repeats counted),
    copies (times the document is used, the last perhaps in part) and positions (training time of
    each use). The first words of the ring are taken again until the target is met, the document at the end in part: each
    source's taken words equal its target rounded to a whole number.

    A null text has size 0 and is never taken. Null sources form one source, last. Rows that
    repeat are separate documents with equal digests. No rows: no rows. A corpus without any
    word: every target is 0. Other columns of ``docs`` are ignored, whatever their names. ``prefix``
    only deals rows out; if it is left out, it follows from their number.
    """
    if prefix is None:
        prefix = LEAST_PREFIX
        rows = docs.count()
        while prefix < 12 and rows > WINDOW_ROWS * 16**prefix:
            prefix += 1
    kept = F.struct(*[F.col(f"`{c}`") for c in keep]) if keep else F.lit(None).cast("string")
    sized = docs.select(
        F.col("doc_id"),
        F.col("source"),
        word_count(F.col("text")).alias("size"),
        F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).alias("digest"),
        kept.alias("kept"),
        F.md5(F.coalesce(F.col("text"), F.lit(""))).alias("text_digest"),
    ).withColumn("part", F.substring("digest", 1, prefix))

    parts = sized.groupBy("source", "part").agg(F.sum("size").alias("part_size"))
    running = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sources = parts.groupBy("source").agg(F.sum("part_size").alias("source_size"))
    targets = source_targets(sources, weights, share, cap)
    starts = (
        parts.withColumn("part_start", F.coalesce(F.sum("part_size").over(running), F.lit(0)))
        .alias("p")
        .join(targets.alias("t"), F.expr("p.source <=> t.source"))
        .select(
            F.col("p.source").alias("s_source"), F.col("part").alias("s_part"), "part_start", "source_size", "w_class", "target"
        )
    )
    inside = Window.partitionBy("source", "part").orderBy("digest", "doc_id", "text_digest").rowsBetween(Window.unboundedPreceding, -1)
    placed = (
        sized.withColumn("before", F.coalesce(F.sum("size").over(inside), F.lit(0)))
        .join(starts, F.expr("source <=> s_source AND part = s_part"))
        .withColumn("start", F.col("part_start") + F.col("before"))
        .withColumn("goal", F.floor(F.col("target") + 0.5))
    )
    rounds = int(-(-cap // 1))
    uses = F.filter(
        F.transform(
            F.sequence(F.lit(0), F.lit(rounds - 1)),
            lambda e: F.struct(
                (e * F.col("source_size") + F.col("start")).alias("at"),
                F.greatest(
                    F.lit(0).cast("long"), F.least(F.col("size"), F.col("goal") - e * F.col("source_size") - F.col("start"))
                ).alias("words"),
            ),
        ),
        lambda u: u["words"] > 0,
    )
    used = placed.withColumn("uses", uses)
    time = None
    for i, schedule in enumerate(schedules):
        at, mine = _times(schedule), F.col("w_class") % len(schedules) == i
        time = F.when(mine, at) if time is None else time.when(mine, at)
    return used.select(
        "doc_id",
        "source",
        "kept",
        "size",
        "source_size",
        "target",
        F.aggregate("uses", F.lit(0).cast("long"), lambda a, u: a + u["words"]).alias("taken"),
        F.size("uses").alias("copies"),
        F.when(F.size("uses") > 0, time).otherwise(F.array().cast("array<double>")).alias("positions"),
    )


def curriculum(docs: DataFrame, columns: Sequence[str], **options) -> DataFrame:
    """The documents in training order: one row per use, range-sorted by position.

    Columns: those in ``columns``, taken from ``docs``. A document used twice appears twice.
    """
    mixed = mix(docs, keep=columns, **options)
    uses = mixed.select("kept", F.explode("positions").alias("position"))
    return uses.orderBy("position").select("kept.*")


def op8(docs: DataFrame) -> DataFrame:
    """What the mix takes of every row of ``docs`` and its training positions, in the order of the first.

    ``first_position`` and ``second_position`` (0 to 1) are the inverse of the source's cumulative
    demand where the first and the second use begin, null without such a use. A null text has size 0
    and is never taken; null sources are one, last. Rows that repeat are documents of their own. No
    rows give none; other columns are ignored, whatever their names.
    """
    mixed = mix(docs)
    at = lambda k: F.round(F.try_element_at("positions", F.lit(k)), 9)
    return (
        mixed.withColumns({"first_position": at(1), "second_position": at(2)})
        .orderBy(F.col("first_position").asc_nulls_last(), "doc_id")
        .select("doc_id", "size", "source_size", "target", "taken", "first_position", "second_position")
    )


OP8_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, md5(CAST(doc_id AS VARCHAR)) AS digest, md5(coalesce(text, '')) AS text_digest,
         CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size
  FROM documents
), sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source
), ranked AS (
  SELECT *, CASE w_class WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight
  FROM (SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS w_class FROM sources)
), ratios AS (SELECT *, 2.0::DOUBLE * source_size / weight AS ratio FROM ranked
), levels AS (
  SELECT *, (1.5::DOUBLE * sum(source_size) OVER ()
      - coalesce(sum(2.0::DOUBLE * source_size) OVER (ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / (sum(weight) OVER () - coalesce(sum(weight) OVER (ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS level
  FROM ratios
), final AS (
  SELECT level FROM levels WHERE level <= ratio ORDER BY ratio, source LIMIT 1
), targets AS (
  SELECT source, source_size, w_class,
    least(coalesce(weight * (SELECT level FROM final), 2.0::DOUBLE * source_size), 2.0::DOUBLE * source_size) AS target
  FROM levels
), placed AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, t.w_class, CAST(floor(t.target + 0.5) AS BIGINT) AS goal,
    coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.digest, d.doc_id, d.text_digest ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM sized d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source
), uses AS (
  SELECT *, greatest(0, least(size, goal - start)) AS first_words, greatest(0, least(size, goal - source_size - start)) AS second_words,
    start / goal::DOUBLE AS first_done, (source_size + start) / goal::DOUBLE AS second_done
  FROM placed
)
SELECT doc_id, size, source_size, target, CAST(first_words + second_words AS BIGINT) AS taken,
  CASE WHEN first_words > 0 THEN round(CASE w_class WHEN 0 THEN 2 * first_done / (1.5 + sqrt(greatest(0, 2.25 - 2 * first_done)))
    WHEN 1 THEN first_done ELSE 2 * first_done / (0.5 + sqrt(0.25 + 2 * first_done)) END, 9) END AS first_position,
  CASE WHEN second_words > 0 THEN round(CASE w_class WHEN 0 THEN 2 * second_done / (1.5 + sqrt(greatest(0, 2.25 - 2 * second_done)))
    WHEN 1 THEN second_done ELSE 2 * second_done / (0.5 + sqrt(0.25 + 2 * second_done)) END, 9) END AS second_position
FROM uses
"""
