"""Quality rules by robust multivariate outliers, in SQL functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from riskloom.session import stage

WINDOW = 8
#: Words are divided by these code points, and no others.
SPACES = "[\\x20\\x09-\\x0D]+"
NO_SYMBOLS = "[^#*$%&|<>]+"
#: Fewest rows that a source of a language, or the small sources of a language, need for an
#: estimate of their own; the rest of the table shares one.
LEAST_ROWS = 200
#: Fewest rows for any estimate; a rest below it is judged by the whole table's, and a whole table
#: below it has no verdict.
LEAST_FIT = 30
#: The transformed statistics, and the standard deviation each has at least: most texts agree on
#: a value, as on no symbols, and the nearest half then has no spread of its own.  Good texts of the
#: test table have 0.048, 0, 0.047 and 0.049; the last two are skewed and so are given half as much again.
FLOORS = {"word_length": 0.05, "symbols": 0.02, "dup_lines": 0.07, "repeats": 0.07}
NAMES = tuple(FLOORS)
#: Chi-squared with four degrees of freedom: the median, and the 0.999 quantile.
MEDIAN = 3.3567
CUTOFF = 18.467
#: Bins per unit of a squared distance's logarithm, in which rows are counted to find the half.
BINS = 64
STEPS = 4
#: Estimates (some 200 bytes each) up to which they are broadcast; more are joined by shuffle.
BROADCAST_KEYS = 50_000


def base_statistics(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Counts over each whole text: ``id_column, lang, source, n_words, word_chars, n_symbols,
    n_dup_lines, n_repeat_words, n_lines``; null texts count as empty."""
    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    kept = [F.col(c).cast("string").alias(f"_{c}") if c in docs.columns else F.lit(None).cast("string").alias(f"_{c}") for c in ("lang", "source")]
    df = docs.select(F.col(id_column).alias("_id"), *kept, text.alias("_text"))
    df = df.select(
        "_id",
        "_lang",
        "_source",
        F.length(F.regexp_replace("_text", SPACES, "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace("_text", NO_SYMBOLS, "")).cast("long").alias("n_symbols"),
        F.filter(F.split("_text", "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]")).alias("_lines"),
        F.transform(
            F.array_remove(F.split("_text", SPACES), ""), lambda w: F.xxhash64(w)
        ).alias("_words"),
    )
    n = F.size("_words")
    # windows are told apart by a 64-bit hash of their words' 64-bit hashes
    windows = F.when(
        n >= WINDOW,
        F.transform(
            F.sequence(F.lit(0), F.greatest(n - WINDOW, F.lit(0))),
            lambda i: F.xxhash64(*[F.get("_words", i + k) for k in range(WINDOW)]),
        ),
    ).otherwise(F.array().cast("array<bigint>"))
    df = df.select(
        "_id",
        "_lang",
        "_source",
        n.cast("long").alias("n_words"),
        "word_chars",
        "n_symbols",
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        windows.alias("_windows"),
    )
    repeated = F.size(F.array_distinct("_windows")) < F.size("_windows")
    # only texts that repeat a window are sorted
    ordered = F.when(
        repeated,
        F.array_sort(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
    )
    df = df.withColumn("_ordered", ordered).drop("_windows")
    twice = F.transform(
        "_ordered",
        lambda x, j: F.when(
            (F.get("_ordered", j - 1)["h"] == x["h"]) | (F.get("_ordered", j + 1)["h"] == x["h"]),
            x["i"],
        ),
    )
    df = df.withColumn("_marked", F.array_sort(F.filter(twice, lambda i: i.isNotNull()))).drop("_ordered")
    covered = F.aggregate(
        F.transform(
            "_marked",
            lambda p, j: F.least(F.lit(WINDOW), F.coalesce(F.get("_marked", j + 1) - p, F.lit(WINDOW))),
        ),
        F.lit(0),
        lambda total, x: total + x,
    )
    return df.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long")).drop("_marked")


def _share(part: str, whole: str, added: int) -> Column:
    """Square root of a share, drawn to 0 for short texts; the root evens out counts' spread."""
    return F.sqrt(F.col(part) / (F.col(whole) + added))


def _cells():
    return [(i, j) for i in range(len(NAMES)) for j in range(i + 1)]


def _few(keyed: DataFrame) -> DataFrame:
    """A stored table of keys, broadcast if it was counted and found small."""
    return F.broadcast(keyed) if keyed.count() <= BROADCAST_KEYS else keyed


def _keyed(rows: DataFrame) -> DataFrame:
    """Each row's estimate: its language and source, the language's small sources, or the rest."""
    mark = lambda *cols: F.concat_ws("\x01", *[F.coalesce(c, F.lit("\x02")) for c in cols])
    # null-safe: absent values are groups of their own
    rows = rows.withColumn("_own", mark("_lang", "_source")).withColumn("_wide", mark("_lang"))
    sources = (
        rows.filter(~F.col("base_failed")).groupBy("_own", "_wide").agg(F.count("_own").alias("_rows"))
    )
    small = F.col("_rows") < LEAST_ROWS
    languages = (
        sources.filter(small)
        .groupBy("_wide")
        .agg((F.sum("_rows") >= LEAST_ROWS).alias("_enough"))
    )
    keys = sources.join(languages, "_wide", "left").select(
        "_own",
        "_rows",
        F.when(~small, F.concat(F.lit("1"), "_own"))
        .when(F.col("_enough"), F.concat(F.lit("2"), "_wide"))
        .otherwise("3")
        .alias("_key"),
    )
    keys = stage(keys, "quality-sources")
    rest = keys.filter("_key = '3'").agg(F.sum("_rows")).first()[0] or 0
    # rows of the whole table stand once more, as estimate only, where too few are left over
    rows = rows.join(_few(keys.drop("_rows")), "_own", "left").withColumn("_judged", F.lit(True))
    if not 0 < rest < LEAST_FIT:
        return rows
    whole = rows.withColumn("_judged", F.col("_key") == "3").withColumn("_key", F.lit("0"))
    return rows.filter(F.coalesce(F.col("_key") != "3", F.lit(True))).unionByName(whole)


def _with_distance(rows: DataFrame, fits: DataFrame) -> DataFrame:
    """Add ``_d2``, the squared Mahalanobis distance by forward substitution."""
    df = rows.join(_few(fits), "_key")
    for i in range(len(NAMES)):
        rest = F.col(f"x{i}") - F.col(f"m{i}")
        for j in range(i):
            rest = rest - F.col(f"l{i}{j}") * F.col(f"z{j}")
        df = df.withColumn(f"z{i}", rest / F.col(f"l{i}{i}"))
    d2 = sum((F.col(f"z{i}") * F.col(f"z{i}") for i in range(1, len(NAMES))), F.col("z0") * F.col("z0"))
    df = df.withColumn("_d2", d2).withColumn("_bin", F.floor(F.log(F.col("_d2") + 1e-9) * BINS))
    return df


def _factor(fits: DataFrame) -> DataFrame:
    """Cholesky factor ``l`` of the covariance ``c`` with the floors added, column by column."""
    df = fits
    for j in range(len(NAMES)):
        for i in range(j, len(NAMES)):
            left = F.col(f"c{i}{j}") + (F.col(f"f{i}") if i == j else F.lit(0.0))
            for k in range(j):
                left = left - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
            if i == j:  # rounding may take the rest below the floor, never the true value
                df = df.withColumn(f"l{i}{i}", F.sqrt(F.greatest(left, F.col(f"f{i}"))))
            else:
                df = df.withColumn(f"l{i}{j}", left / F.col(f"l{j}{j}"))
    n = range(len(NAMES))
    return df.select("_key", *[f"m{i}" for i in n], *[f"f{i}" for i in n], *[f"l{i}{j}" for i, j in _cells()])


def _half(measured: DataFrame) -> DataFrame:
    """The bin of each key up to which half of its rows lie, with sums over the bins so far.

    Rows are summed per key and bin before the shuffle, so a hot source meets in as many rows as
    there are bins (some thousands), and so does the window.
    """
    sums = [F.count("_key").alias("n")]
    sums += [F.sum(f"x{i}").alias(f"s{i}") for i in range(len(NAMES))]
    sums += [F.sum(F.col(f"x{i}") * F.col(f"x{j}")).alias(f"s{i}{j}") for i, j in _cells()]
    bins = measured.groupBy("_key", "_bin").agg(*sums, *[F.first(f"f{i}").alias(f"f{i}") for i in range(len(NAMES))])
    so_far = Window.partitionBy("_key").orderBy("_bin").rowsBetween(Window.unboundedPreceding, 0)
    names = ["n", *[f"s{i}" for i in range(len(NAMES))], *[f"s{i}{j}" for i, j in _cells()]]
    run = bins.select(
        "_key",
        "_bin",
        *[f"f{i}" for i in range(len(NAMES))],
        *[F.sum(x).over(so_far).alias(x) for x in names],
        F.sum("n").over(Window.partitionBy("_key")).alias("_all"),
        (F.sum("n").over(so_far) - F.col("n")).alias("_before"),
    )
    half = F.ceil((F.col("_all") + len(NAMES) + 1) / 2)
    return run.filter((F.col("_before") < half) & (F.col("n") >= half))


def _concentrated(measured: DataFrame) -> DataFrame:
    """One concentration step: mean and covariance of the half that is nearest."""
    half = _half(measured)
    return _factor(
        half.select(
            "_key",
            *[f"f{i}" for i in range(len(NAMES))],
            *[(F.col(f"s{i}") / F.col("n")).alias(f"m{i}") for i in range(len(NAMES))],
            *[
                (F.col(f"s{i}{j}") / F.col("n") - F.col(f"s{i}") * F.col(f"s{j}") / F.col("n") / F.col("n")).alias(f"c{i}{j}")
                for i, j in _cells()
            ],
        )
    )


def quality_rules(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Counts, base rule and the verdict of a minimum-covariance-determinant estimate.

    Base rule: fewer than 20 words, or over 30 % of the words in 8-word windows that occur twice.
    The other rows give, per language and source, the location and scatter of their statistics
    (mean word length, and shares of symbols, repeated lines and repeated words): from medians,
    ``STEPS`` concentration steps go to mean and covariance of the half nearest so far, with
    ``FLOORS`` added to the variances.  The scatter is scaled so that the median distance is that
    of a normal sample, never downwards; rows beyond ``CUTOFF`` are rejected.  Distances are cut
    at bins of 1/64 of their logarithm, so the half is exact to a bin and the same in any order.

    Sources of fewer than ``LEAST_ROWS`` rows share an estimate per language, or else one for the
    rest; a rest of fewer than ``LEAST_FIT`` rows is judged by an estimate of the whole table.  Only
    if that has fewer there is no verdict and the base rule decides.
    Null, empty and blank texts fail the base rule; null languages and sources are groups of their
    own, and tables without these columns form one.  Returns one row per input row, repeated rows
    included: ``id_column, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, kept, distance`` (null without verdict).  Other columns are left out.
    """
    n = range(len(NAMES))
    counted = base_statistics(docs, id_column, text_column)
    words = F.col("n_words")
    counted = counted.withColumn(
        "base_failed", (words < 20) | (100 * F.col("n_repeat_words") > 30 * words)
    ).withColumns(
        {
            "_v0": F.log((F.col("word_chars") + 1) / (words + 1)),
            "_v1": _share("n_symbols", "word_chars", 200),
            "_v2": _share("n_dup_lines", "n_lines", 10),
            "_v3": _share("n_repeat_words", "n_words", 20),
        }
    )
    counted = stage(counted.withColumn("_row", F.monotonically_increasing_id()), "quality-counts")
    rows = stage(_keyed(counted), "quality-keys")
    fit = rows.filter(~F.col("base_failed"))
    start = fit.groupBy("_key").agg(
        F.count("_key").alias("_rows"),
        *[F.percentile_approx(f"_v{i}", [0.25, 0.5, 0.75], 1000).alias(f"q{i}") for i in n],
    ).filter(F.col("_rows") >= LEAST_FIT)
    # quartiles give a start that half of the rows cannot move; sums are taken about the medians
    start = stage(
        start.select(
            "_key",
            *[F.col(f"q{i}")[1].alias(f"o{i}") for i in n],
            *[F.pow((F.col(f"q{i}")[2] - F.col(f"q{i}")[0]) / 1.349, F.lit(2.0)).alias(f"c{i}{i}") for i in n],
        ),
        "quality-start",
    )
    centred = rows.join(_few(start.select("_key", *[f"o{i}" for i in n])), "_key").select(
        "_row", "_key", "_judged", "base_failed", *[(F.col(f"_v{i}") - F.col(f"o{i}")).alias(f"x{i}") for i in n]
    )
    centred = stage(centred.filter(~F.col("base_failed")).drop("base_failed"), "quality-centred")
    fits = stage(_factor(
        start.select(
            "_key",
            *[F.lit(0.0).alias(f"m{i}") for i in n],
            *[F.lit(FLOORS[NAMES[i]] ** 2).alias(f"f{i}") for i in n],
            *[(F.col(f"c{i}{j}") if i == j else F.lit(0.0)).alias(f"c{i}{j}") for i, j in _cells()],
        )
    ), "quality-fit")
    for _ in range(STEPS):
        fits = stage(_concentrated(_with_distance(centred, fits)), "quality-fit")
    measured = _with_distance(centred, fits).select("_row", "_key", "_judged", "_d2", "_bin", *[f"x{i}" for i in n], *[f"f{i}" for i in n])
    scale = _half(measured).select(
        "_key", F.greatest(F.lit(1.0), F.exp((F.col("_bin") + 1) / BINS) / MEDIAN).alias("_scale")
    )
    judged = measured.filter("_judged").join(_few(stage(scale, "quality-scale")), "_key").select(
        "_row", F.sqrt(F.col("_d2") / F.col("_scale")).alias("distance")
    )
    near = F.coalesce(F.col("distance") * F.col("distance") <= CUTOFF, F.lit(True))
    return counted.join(judged, "_row", "left").select(
        F.col("_id").alias(id_column),
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        (~F.col("base_failed") & near).alias("kept"),
        "distance",
    )
