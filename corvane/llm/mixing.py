"""Mixing sources to target weights by entropy balancing.

Sources, in code-point order with null last, take the weights in turn. Each source's target is its share of
all tokens, at most `cap` times its own; the excess goes to the others by weight.

Balancing minimises the token-weighted relative entropy of document rates to 1, each rate below `cap`, subject
to token constraints: every source's tokens come to its target, and their mean log2 length to that of all tokens, so that what a source gains or loses doesn't come
from its shortest or longest documents alone. The second constraint is a soft one (`RIDGE`: about half of the way to that mean), as it may be out of reach. The dual is convex with two
multipliers per source; a document's rate is cap / (1 + (cap - 1) * exp(-(lambda + mu * z))), z being its log2 length less the mean: an exponential
tilt of its odds. Each Newton step sums gradient and Hessian over the documents' sizes in one distributed aggregate, solves the 2 x 2 systems of all sources
and writes the multipliers; only the largest residual comes back to the driver. Sums are decimal, so no order of addition changes a digit.

Rates are rounded into copies: a document gets floor(rate), and the fraction becomes one more copy for some. Each document has a priority, a
hash of its id and text divided by its fraction, mapped to [0, 1) and cut into `BUCKETS`; documents are in classes by the power of two of their
size. From large sizes to small ones, each class gives one more copy to whole buckets, lowest first, up to what is still due, and what is
over or missing passes on to the next class, so the error left is about half a bucket of the smallest documents. No document
is ordered or moved; the pass over the documents only looks its class up.

Sources are as many as there may be: they are ranked by range partitions, targets are found in rounds of aggregates, and no window runs over all of them.

Defined cases: null text has size 0; documents of size 0 take 0; null ids are told apart by their texts; repeated rows are
treated alike, one by one; an empty table gives no rows; other columns pass through unused.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import P, WORD, materialise, scratch, text_of

BUCKETS = 1024
#: Newton steps at most, the residual (share of the target) at which they end, and the weight of the soft constraint.
STEPS = 60
CLOSE = 1e-10
RIDGE = 1.0
#: Closer to a whole number than this, a rate is one.
WHOLE = 1e-9


def _sized(docs: DataFrame, key: str, text: str, source: str) -> DataFrame:
    size = F.col(f"{P}size")
    draw = F.pmod(F.xxhash64(F.coalesce(F.col(key).cast("string"), F.lit("")), text_of(text), F.lit(17)), F.lit(1 << 52)).cast("double")
    return (
        docs.withColumn(f"{P}size", F.regexp_count(text_of(text), F.lit(WORD)).cast("long"))
        .withColumn(f"{P}class", F.when(size > 0, F.floor(F.log2(size.cast("double")) + 1e-12)).otherwise(-1).cast("int"))
        .withColumn(f"{P}draw", (draw + 0.5) / float(1 << 52))
        .withColumn(f"{P}source", F.col(source))
    )


def exact(x: Column) -> Column:
    """A double as a decimal, whose sums don't depend on the order."""
    return F.round(x, 6).cast("decimal(30,6)")


def _weighted(totals: DataFrame, weights: tuple[float, ...]) -> DataFrame:
    """totals with the weight of each source by its rank: ranges of sources are counted, then ranked inside."""
    order = F.col(f"{P}source").asc_nulls_last()
    dealt = materialise(totals.repartitionByRange(order).withColumn(f"{P}part", F.spark_partition_id()), "mix-sources")
    parts = dealt.groupBy(F.col(f"{P}part").alias(f"{P}p")).agg(F.count(F.lit(1)).alias(f"{P}k"))
    # One row per partition.
    parts = parts.withColumn(f"{P}before", F.coalesce(F.sum(f"{P}k").over(Window.orderBy(f"{P}p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop(f"{P}k")
    ranked = dealt.withColumn(f"{P}r", F.row_number().over(Window.partitionBy(f"{P}part").orderBy(order))).join(parts, F.col(f"{P}part") == F.col(f"{P}p"))
    at = F.pmod(F.col(f"{P}before") + F.col(f"{P}r") - 1, F.lit(len(weights))) + 1
    return ranked.withColumn(f"{P}w", F.element_at(F.array(*[F.lit(float(x)) for x in weights]), at.cast("int"))).drop(f"{P}part", f"{P}p", f"{P}r", f"{P}before")


def targets(totals: DataFrame, weights: tuple[float, ...], cap: float) -> DataFrame:
    """totals (__cv_source, __cv_source_size) with __cv_w and __cv_target. One row per source."""
    t = materialise(_weighted(totals, weights), "mix-weights")
    size, w = F.col(f"{P}source_size"), F.col(f"{P}w")
    level = None
    while True:
        # Tokens per weight for the sources that are not full; it only rises, as more of them are.
        full = F.lit(False) if level is None else cap * size < F.lit(level) * w
        r = t.agg(F.sum(size).alias("all"), F.sum(F.when(full, size)).alias("full"), F.sum(F.when(~full, w)).alias("w")).first()
        now = (r["all"] - cap * (r["full"] or 0)) / r["w"] if r["w"] else level or 0.0
        if level is not None and now <= level:
            break
        level = now
    return t.withColumn(f"{P}target", F.least(cap * size, F.lit(float(level)) * w).cast("double"))


def rate(size: Column, lam: Column, mu: Column, mean: Column | float, cap: float) -> Column:
    """The rate of a document of a size; cap where the multiplier is null, in sources that are full."""
    x = lam + mu * (F.log2(size.cast("double")) - mean)
    return F.when(lam.isNull(), F.lit(float(cap))).otherwise(F.lit(float(cap)) / (1 + (cap - 1) * F.exp(-x)))


def balanced(sizes: DataFrame, t: DataFrame, mean: float, cap: float) -> DataFrame:
    """t with the multipliers __cv_lambda and __cv_mu of each source. sizes: __cv_source, __cv_size (above 0), n."""
    size, target = F.col(f"{P}source_size").cast("double"), F.col(f"{P}target")
    quotient = target / size
    start = F.when((size > 0) & (target < cap * size * (1 - 1e-12)), F.log((cap - 1) * quotient / (cap - quotient)))
    now = materialise(t.select("*", start.alias(f"{P}lambda"), F.when(start.isNotNull(), 0.0).alias(f"{P}mu")), "mix-multipliers")
    tokens, z = (F.col(f"{P}size") * F.col("n")).cast("double"), F.log2(F.col(f"{P}size").cast("double")) - mean
    cells = sizes.select(F.col(f"{P}source").alias(f"{P}of"), F.col(f"{P}size").alias("size"), tokens.alias("tokens"), z.alias("z"))
    for _ in range(STEPS):
        open_ = now.filter(f"{P}lambda is not null").select(f"{P}source", f"{P}lambda", f"{P}mu")
        r = rate(F.col("size"), F.col(f"{P}lambda"), F.col(f"{P}mu"), mean, cap)
        taken = F.col("tokens") * r
        slope = taken * (1 - r / cap)
        z = F.col("z")
        sums = {"g0": taken, "g1": taken * z, "h00": slope, "h01": slope * z, "h11": slope * z * z}
        step = cells.join(open_, F.col(f"{P}of").eqNullSafe(F.col(f"{P}source"))).groupBy(f"{P}of").agg(*[F.sum(exact(x)).cast("double").alias(k) for k, x in sums.items()])
        j = now.join(step, F.col(f"{P}source").eqNullSafe(F.col(f"{P}of")), "left").drop(f"{P}of")
        a, b = F.col("g0") - target, F.col("g1") + RIDGE * target * F.col(f"{P}mu")
        h11 = F.col("h11") + RIDGE * target
        det = F.greatest(F.col("h00") * h11 - F.col("h01") * F.col("h01"), F.lit(1e-300))
        by_lambda, by_mu = (h11 * a - F.col("h01") * b) / det, (F.col("h00") * b - F.col("h01") * a) / det
        # Damped along the step's own direction.
        part = F.least(F.lit(1.0), F.lit(3.0) / F.greatest(F.abs(by_lambda), F.lit(1e-9)), F.lit(1.0) / F.greatest(F.abs(by_mu), F.lit(1e-9)))
        moved = {f"{P}lambda": F.col(f"{P}lambda") - part * by_lambda, f"{P}mu": F.col(f"{P}mu") - part * by_mu}
        off = F.when(F.col(f"{P}lambda").isNotNull(), F.greatest(F.abs(a), F.abs(b)) / F.greatest(target, F.lit(1.0)))
        now = materialise(j.select(*[F.coalesce(moved[c], F.col(c)).alias(c) if c in moved else F.col(c) for c in now.columns if c != "off"], off.alias("off")), "mix-multipliers")
        # Sums are rounded at the sixth place, which is all that tiny sources can be held to.
        if (now.agg(F.max(F.when(F.col("off") * F.greatest(target, F.lit(1.0)) > 1e-4, F.col("off")))).first()[0] or 0.0) < CLOSE:
            break
    return now.drop("off")


def _parts(size: Column, r: Column, draw: Column) -> tuple[Column, Column, Column]:
    """(whole copies, fraction, bucket of priorities; the last bucket is for those without a fraction)."""
    whole = F.floor(r + WHOLE)
    part = F.when((size > 0) & (r - whole > WHOLE), r - whole).otherwise(0.0)
    return whole.cast("int"), part, F.when(part > 0, F.least(F.lit(BUCKETS - 1), F.floor(draw / (draw + part) * BUCKETS))).otherwise(BUCKETS).cast("int")


def plan(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", weights: tuple[float, ...] = (5, 2, 1), cap: float = 3.0) -> DataFrame:
    """One row per (source, size class): target, multipliers, mean log2 length and the last bucket that gets one more copy."""
    with scratch(docs.sparkSession):
        few = materialise(_sized(docs, key, text, source).select(f"{P}source", f"{P}size", f"{P}class", f"{P}draw"), "mix-sizes")
        sizes = materialise(few.groupBy(f"{P}source", f"{P}size").agg(F.count(F.lit(1)).alias("n")), "mix-histogram")
        t = targets(sizes.groupBy(f"{P}source").agg(F.sum(F.col(f"{P}size") * F.col("n")).alias(f"{P}source_size")), weights, cap)
        worded = sizes.filter(f"{P}size > 0")
        tokens = (F.col(f"{P}size") * F.col("n")).cast("double")
        r = worded.agg(F.sum(exact(tokens * F.log2(F.col(f"{P}size").cast("double")))).alias("a"), F.sum(exact(tokens)).alias("b")).first()
        mean = float(r["a"] / r["b"]) if r["b"] else 0.0
        t = balanced(worded, t, mean, cap).withColumn(f"{P}mean", F.lit(mean))

        facts = t.select(F.col(f"{P}source").alias(f"{P}s"), f"{P}lambda", f"{P}mu")
        _, part, bucket = _parts(F.col(f"{P}size"), rate(F.col(f"{P}size"), F.col(f"{P}lambda"), F.col(f"{P}mu"), mean, cap), F.col(f"{P}draw"))
        placed = few.join(facts, F.col(f"{P}source").eqNullSafe(F.col(f"{P}s"))).select(f"{P}source", f"{P}class", f"{P}size", part.alias("part"), bucket.alias("bucket"))
        cell = placed.groupBy(f"{P}source", f"{P}class", "bucket").agg(F.sum(F.when(F.col("part") > 0, F.col(f"{P}size")).otherwise(0)).alias("tokens"), F.sum(exact(F.col("part") * F.col(f"{P}size"))).alias("due"))
        cell = materialise(cell, "mix-cells")
        running = Window.partitionBy(f"{P}source", f"{P}class").orderBy("bucket")
        runs = F.collect_list(F.when(F.col("bucket") < BUCKETS, F.struct(F.col("run").alias("run"), F.col("bucket").alias("bucket"))))
        classes = cell.withColumn("run", F.sum("tokens").over(running)).groupBy(f"{P}source", f"{P}class").agg(F.sum("due").cast("double").alias("due"), runs.alias("runs"))
        classes = classes.groupBy(F.col(f"{P}source").alias(f"{P}s")).agg(F.sort_array(F.collect_list(F.struct(F.col(f"{P}class").alias("class"), "due", "runs")), asc=False).alias(f"{P}classes"))

        def take(acc: Column, c: Column) -> Column:
            due = acc["due"] + c["due"]
            none = F.array(F.struct(F.lit(0).cast("long").alias("run"), F.lit(-1).alias("bucket")))
            best = F.array_min(F.transform(F.concat(none, c["runs"]), lambda x: F.struct(F.abs(x["run"] - due).alias("off"), x["bucket"].alias("bucket"), x["run"].alias("run"))))
            return F.struct((due - best["run"]).alias("due"), F.concat(acc["cuts"], F.array(F.struct(c["class"].alias("class"), best["bucket"].alias("cut")))).alias("cuts"))

        start = F.struct(F.lit(0.0).alias("due"), F.array().cast("array<struct<class:int,cut:int>>").alias("cuts"))
        out = t.join(classes, F.col(f"{P}source").eqNullSafe(F.col(f"{P}s"))).withColumn(f"{P}cut", F.explode(F.aggregate(f"{P}classes", start, take, lambda acc: acc["cuts"])))
        return materialise(out.select(F.col(f"{P}source").alias(f"{P}to"), f"{P}source_size", f"{P}target", f"{P}lambda", f"{P}mu", f"{P}mean", F.col(f"{P}cut.class").alias(f"{P}to_class"), F.col(f"{P}cut.cut").alias(f"{P}last")), "mix-plan", keep=True)


def mix(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", weights: tuple[float, ...] = (5, 2, 1), cap: float = 3.0) -> DataFrame:
    """docs with __cv_size, __cv_source_size, __cv_target, __cv_rate and __cv_copies (0 to cap)."""
    p = plan(docs, key, text, source, weights, cap)
    sized = _sized(docs, key, text, source)
    joined = sized.join(p, sized[f"{P}source"].eqNullSafe(p[f"{P}to"]) & (sized[f"{P}class"] == p[f"{P}to_class"]))
    size = F.col(f"{P}size")
    joined = joined.withColumn(f"{P}rate", F.when(size == 0, 0.0).otherwise(rate(size, F.col(f"{P}lambda"), F.col(f"{P}mu"), F.col(f"{P}mean"), cap)))
    whole, part, bucket = _parts(size, F.col(f"{P}rate"), F.col(f"{P}draw"))
    copies = F.when(size > 0, whole + F.when((part > 0) & (bucket <= F.col(f"{P}last")), 1).otherwise(0)).otherwise(0)
    return joined.withColumn(f"{P}copies", F.least(copies, F.lit(int(cap))).cast("int"))


def mixed(docs: DataFrame, **how) -> DataFrame:
    """docs, each row as often as the mix takes it. Same columns."""
    m = mix(docs, **how).filter(F.col(f"{P}copies") > 0)
    return m.withColumn(f"{P}copy", F.explode(F.sequence(F.lit(1), F.col(f"{P}copies")))).select(*[m[c] for c in docs.columns])


def query(spark, sf_dir: str) -> DataFrame:
    from .common import documents

    m = mix(documents(spark, sf_dir))
    return m.select("doc_id", F.col(f"{P}size").alias("size"), F.col(f"{P}source_size").cast("long").alias("source_size"), F.col(f"{P}target").alias("target"), (F.col(f"{P}copies") * F.col(f"{P}size")).cast("long").alias("taken"), F.col(f"{P}rate").alias("rate"), F.col(f"{P}copies").alias("copies"))


def query_targets(spark, sf_dir: str) -> DataFrame:
    """Size and target of every source."""
    from .common import documents

    docs = documents(spark, sf_dir).select(F.col("source").alias(f"{P}source"), F.regexp_count(text_of("text"), F.lit(WORD)).cast("long").alias("n"))
    t = targets(docs.groupBy(f"{P}source").agg(F.sum("n").alias(f"{P}source_size")), (5, 2, 1), 3.0)
    return t.select(F.col(f"{P}source").alias("source"), F.col(f"{P}source_size").alias("source_size"), F.round(f"{P}target", 4).alias("target"))
