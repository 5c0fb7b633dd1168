"""Quality rules with robust multivariate outliers: DataFrame functions only.

Base statistics of every whole text come from array functions within the row (no
explode, no shuffle). Texts that pass the base rules are then judged per language and
source by a minimum-covariance-determinant estimate of four transformed statistics:
log mean word length, and the square roots of the shares of symbols, of repeated words
and of repeated lines (per word). Concentration steps look for the 75 % of a group whose
covariance has the least determinant: keep the 75 % nearest in Mahalanobis distance, take
their mean and covariance anew. Each group has three deterministic starts about its
medians: the squared median absolute deviations, and these with the correlations of
the deviations' hyperbolic tangents or of their spatial signs. All take ``FIRST_STEPS``
steps; of the three the least determinant goes on, as long as it falls (by more than
``FALL`` in its logarithm; at most ``MOST_STEPS``), and the least seen is kept.

A step is one scan with one exchange: moments are added up per group and fine step of
the distance, so a group that holds a third of all rows is at most a few thousand sums
per task, and only groups whose determinant still falls are scanned. Variances have a
floor (``FLOOR``), added to the diagonal, as most texts have no symbols or repeats at all.
A text is rejected beyond the 0.9999 quantile of chi-square with 4 degrees.

Defined cases: a null text counts as empty and fails the base rules; a null language
or source is a value of its own; groups under ``LEAST`` passing rows reject nothing;
repeated rows count each; an empty table gives an empty result; further columns are
ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from branchbook.llm.common import stored
from branchbook.operators.joins import plan_size_bytes

WHITE = " \t\n\x0b\x0c\r"
SPLIT = r"[\x20\x09-\x0D]+"
SYMBOLS = "[#*$%&|<>]+"
FIRST_STEPS, MOST_STEPS = 2, 30
FALL = 1e-3
FINE = 64  # steps of the distance for each factor e
SHARE = 0.75
CONSISTENCY = 1.49  # of the covariance of the nearest 75 % in 4 dimensions
CUT = 23.51  # chi-square, 4 degrees, 0.9999
FLOOR = (0.1, 0.05, 0.1, 0.05)
LEAST = 10
SMALL_BYTES = 32 << 20  # group tables up to this size are broadcast
SALTS = 32
X = ["x0", "x1", "x2", "x3"]


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source and the base statistics of every row."""
    t = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source"),
        F.coalesce("text", F.lit("")).alias("t"),
    )
    trimmed = F.btrim("t", F.lit(WHITE))
    lines = F.filter(F.split("t", "\n"), lambda x: F.length(F.btrim(x, F.lit(WHITE))) > 0)
    a = t.select(
        "doc_id", "lang", "source", lines.alias("lines"),
        F.when(trimmed == "", F.expr("cast(array() as array<string>)")).otherwise(F.split(trimmed, SPLIT)).alias("words"),
        (F.length("t") - F.length(F.regexp_replace("t", SYMBOLS, ""))).cast("bigint").alias("n_symbols"),
    )
    b = a.select(
        "doc_id", "lang", "source", F.length(F.array_join("words", "")).cast("bigint").alias("word_chars"), "n_symbols", F.size("words").cast("bigint").alias("n_words"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("h"),
    )
    n = F.greatest(F.size("h") - 2, F.lit(0))
    pairs = F.zip_with(F.slice("h", F.lit(1), n), F.slice("h", F.lit(2), n), lambda x, y: F.xxhash64(x, y))
    rest = ["doc_id", "lang", "source", "word_chars", "n_symbols", "n_words", "n_dup_lines"]
    c = b.select(*rest, F.zip_with(pairs, F.slice("h", F.lit(3), n), lambda x, y: F.xxhash64(x, y)).alias("w3"))
    d = c.select(*rest, F.when(F.size(F.array_distinct("w3")) < F.size("w3"), F.sort_array(F.transform("w3", lambda x, i: F.struct(x.alias("h"), i.alias("p"))))).alias("s"))
    twin = F.zip_with("s", F.slice("s", F.lit(2), F.size("s") - 1), lambda x, y: F.when(x["h"] == y["h"], F.array(x["p"], y["p"])))
    at = F.sort_array(F.array_distinct(F.flatten(F.filter(twin, lambda x: x.isNotNull()))))
    zero = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(-3).alias("last"))
    cover = F.aggregate(at, zero, lambda acc, p: F.struct((acc["n"] + F.least(F.lit(3), p - acc["last"])).alias("n"), p.alias("last")), lambda acc: acc["n"])
    return d.select(*rest, F.when(F.col("s").isNull(), F.lit(0).cast("bigint")).otherwise(cover).alias("n_repeat_words"))


def _key(c: str) -> Column:
    return F.coalesce(F.concat(F.length(c), F.lit(":"), F.col(c)), F.lit("-"))


def vectors(stats: DataFrame) -> DataFrame:
    """Group key, base verdict and transformed statistics."""
    words, chars = F.greatest("n_words", F.lit(1)), F.greatest("word_chars", F.lit(1))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return stats.withColumns({
        "g": F.concat(_key("lang"), F.lit("/"), _key("source")), "base_failed": failed, "x0": F.log(chars / words),
        "x1": F.sqrt(F.col("n_symbols") / chars), "x2": F.sqrt(F.col("n_repeat_words") / words), "x3": F.sqrt(F.col("n_dup_lines") / words),
    })


def _ranked(rows: DataFrame, by: list[str], step: Column, share: float) -> DataFrame:
    """Per group the least step that ``share`` of its rows lie in or under."""
    counts = rows.groupBy(*by, step.alias("step")).agg(F.count("*").alias("c"))
    w = Window.partitionBy(*by)
    run = F.sum("c").over(w.orderBy("step").rowsBetween(Window.unboundedPreceding, 0))
    return counts.withColumns({"run": run, "all": F.sum("c").over(w)}).where(F.col("run") >= share * F.col("all")).groupBy(*by).agg(F.min("step").alias("step"))


LOWER = [(i, j) for i in range(4) for j in range(i + 1)]
ESTIMATE = [f"m{i}" for i in range(4)] + [f"l{i}{j}" for i, j in LOWER]


def _factored(moments: DataFrame, by: list[str], scale: float = CONSISTENCY, floor: tuple = FLOOR) -> DataFrame:
    """Mean m_i, lower Cholesky factor l_ij of the covariances c_ji, floors added to the diagonal, and logdet.

    One column after another: an entry is used several times and stays a column of its own.
    """
    out = moments
    for j in range(4):
        for i in range(j, 4):
            v = F.coalesce(f"c{j}{i}", F.lit(0.0)) * scale
            if i == j:
                v = v + floor[i] ** 2
            for k in range(j):
                v = v - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
            out = out.withColumn(f"l{i}{j}", F.sqrt(F.greatest(v, F.lit(FLOOR[i] ** 2 / 4))) if i == j else v / F.col(f"l{j}{j}"))
    return out.select(*by, *ESTIMATE, (2 * F.log(F.col("l00") * F.col("l11") * F.col("l22") * F.col("l33"))).alias("logdet"))


def with_distance(rows: DataFrame) -> DataFrame:
    """Adds d2, the squared Mahalanobis distance from the mean m_i and factor l_ij beside the row."""
    for i in range(4):
        v = F.col(f"x{i}") - F.col(f"m{i}")
        for k in range(i):
            v = v - F.col(f"l{i}{k}") * F.col(f"y{k}")
        rows = rows.withColumn(f"y{i}", v / F.col(f"l{i}{i}"))
    return rows.withColumn("d2", sum((F.col(f"y{i}") * F.col(f"y{i}") for i in range(1, 4)), F.col("y0") * F.col("y0")))


def beside(rows: DataFrame, groups: DataFrame, how: str = "inner", limit: int = SMALL_BYTES) -> DataFrame:
    """Rows with what a stored table says of their group g: broadcast up to ``limit`` bytes, beyond
    that joined by group and salt, so that no group's rows meet in one task."""
    size = plan_size_bytes(groups)
    if size is not None and size <= limit:
        return rows.join(F.broadcast(groups), "g", how)
    salted = groups.withColumn("__salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(SALTS - 1).cast("bigint"))))
    return rows.withColumn("__salt", F.pmod(F.monotonically_increasing_id(), F.lit(SALTS))).join(salted, ["g", "__salt"], how).drop("__salt")


def _starts(rows: DataFrame) -> DataFrame:
    """Per group g and start (0, 1, 2): the mean and factor to begin with."""
    fine = 1000
    long = rows.select("g", F.posexplode(F.array(*X)).alias("i", "x"))
    mid = stored(_ranked(long, ["g", "i"], F.round(F.col("x") * fine), 0.5).select("g", "i", (F.col("step") / fine).alias("mid")), "medians")
    wide_mid = stored(mid.groupBy("g").agg(F.map_from_entries(F.collect_list(F.struct("i", "mid"))).alias("mids")), "medians-by-group")  # 4 entries
    dev = beside(long, wide_mid).withColumn("mid", F.col("mids")[F.col("i")])
    mad = _ranked(dev, ["g", "i"], F.round(F.abs(F.col("x") - F.col("mid")) * fine), 0.5).select("g", "i", (1.4826 * F.col("step") / fine).alias("mad"))
    wide = stored(mid.join(mad, ["g", "i"]), "deviations").groupBy("g").agg(
        *[F.max(F.when(F.col("i") == i, F.col("mid"))).alias(f"m{i}") for i in range(4)],
        *[F.sqrt(F.max(F.when(F.col("i") == i, F.col("mad"))) ** 2 + FLOOR[i] ** 2).alias(f"s{i}") for i in range(4)])
    wide = stored(wide, "scales")
    z = beside(rows, wide).select("g", *[((F.col(f"x{i}") - F.col(f"m{i}")) / F.col(f"s{i}")).alias(f"z{i}") for i in range(4)])
    z = z.withColumn("r", F.sqrt(sum((F.col(f"z{i}") ** 2 for i in range(1, 4)), F.col("z0") ** 2)))
    forms = {"t": lambda i: F.tanh(f"z{i}"), "p": lambda i: F.when(F.col("r") > 0, F.col(f"z{i}") / F.col("r")).otherwise(0.0)}
    met = z.groupBy("g").agg(*[F.avg(f(i) * f(j)).alias(f"{n}{j}{i}") for n, f in forms.items() for i, j in LOWER])
    met = stored(wide.join(met, "g"), "correlations")
    out = None
    for start, n in enumerate((None, "t", "p")):
        def entry(j: int, i: int, n=n) -> Column:
            if i == j:
                return F.col(f"s{i}") ** 2
            if n is None:
                return F.lit(0.0)
            size = F.sqrt(F.col(f"{n}{i}{i}") * F.col(f"{n}{j}{j}"))
            return F.when(size > 1e-12, 0.95 * F.col(f"{n}{j}{i}") / size).otherwise(0.0) * F.col(f"s{i}") * F.col(f"s{j}")

        covariances = met.select("g", F.lit(start).alias("start"), *[f"m{i}" for i in range(4)], *[entry(j, i).alias(f"c{j}{i}") for i, j in LOWER])
        given = _factored(covariances, ["g", "start"], 1.0, (0.0,) * 4)
        out = given if out is None else out.unionByName(given)
    return out


def _concentrated(rows: DataFrame, params: DataFrame) -> DataFrame:
    """One concentration step: mean, factor and logdet of the ``SHARE`` of each group nearest to its estimate, by g and start."""
    by = ["g", "start"]
    far = with_distance(beside(rows, params.select(*by, *ESTIMATE)))
    v = [F.col(f"x{i}") - F.col(f"m{i}") for i in range(4)]
    sums = [F.sum(v[i]).alias(f"a{i}") for i in range(4)] + [F.sum(v[i] * v[j]).alias(f"b{j}{i}") for i, j in LOWER]
    bins = far.groupBy(*by, F.floor(F.log(F.col("d2") + 1e-9) * FINE).alias("step")).agg(
        F.count("*").alias("c"), *[F.first(f"m{i}").alias(f"m{i}") for i in range(4)], *sums)
    w = Window.partitionBy(*by)
    before = F.coalesce(F.sum("c").over(w.orderBy("step").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    near = bins.withColumns({"before": before, "all": F.sum("c").over(w)}).where(F.col("before") < SHARE * F.col("all"))
    total = near.groupBy(*by).agg(
        F.sum("c").alias("n"), *[F.first(f"m{i}").alias(f"m{i}") for i in range(4)],
        *[F.sum(f"a{i}").alias(f"a{i}") for i in range(4)], *[F.sum(f"b{j}{i}").alias(f"b{j}{i}") for i, j in LOWER])
    mean = [F.col(f"a{i}") / F.col("n") for i in range(4)]
    moments = total.select(*by, *[(F.col(f"m{i}") + mean[i]).alias(f"m{i}") for i in range(4)],
                           *[(F.col(f"b{j}{i}") / F.col("n") - mean[i] * mean[j]).alias(f"c{j}{i}") for i, j in LOWER])
    return stored(_factored(moments, by), "concentrated")


def estimates(rows: DataFrame) -> DataFrame:
    """Per group g: mean m0..m3, factor l00..l33 and logdet of the minimum-covariance-determinant estimate."""
    params = stored(_starts(rows), "starts")
    for _ in range(FIRST_STEPS):
        params = _concentrated(rows, params)
    names = ["start", *ESTIMATE, "logdet"]
    least = params.groupBy("g").agg(F.min_by(F.struct(*names), F.struct("logdet", "start")).alias("e")).select("g", "e", F.lit(True).alias("falls"))
    best = stored(least, "least")
    for _ in range(MOST_STEPS):
        falling = best.where("falls")
        if falling.isEmpty():
            break
        new = _concentrated(rows, falling.select("g", "e.*")).select("g", F.struct(*names).alias("new"))
        less = F.coalesce(F.col("new.logdet") < F.col("e.logdet"), F.lit(False))
        far = F.coalesce(F.col("new.logdet") < F.col("e.logdet") - FALL, F.lit(False))
        best = stored(best.join(new, "g", "left").select("g", F.when(less, F.col("new")).otherwise(F.col("e")).alias("e"), far.alias("falls")), "least")
    return best.select("g", "e.*").drop("start")


def judged(docs: DataFrame) -> DataFrame:
    """One row per document row: the base statistics, base_failed, the distance and kept."""
    rows = stored(vectors(statistics(docs)), "statistics")
    passing = rows.where("not base_failed")
    enough = stored(passing.groupBy("g").agg(F.count("*").alias("c")).where(F.col("c") >= LEAST).select("g"), "groups")
    params = stored(estimates(beside(passing, enough).select("g", *X)), "estimates")
    out = with_distance(beside(rows, params, "left"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                      (~F.col("base_failed") & (F.coalesce("d2", F.lit(0.0)) <= CUT)).alias("kept"), "d2")
