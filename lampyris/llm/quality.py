"""Quality rules: fixed limits, then robust multivariate outliers per language and source. DataFrame expressions only.

Each text gives a vector of transformed statistics (STATISTICS), rounded to a grid of GRID. For every group of language
and source a minimum-covariance-determinant estimate is sought from several starts, the quartiles with the absolute
deviations from the median, by concentration steps: keep the share ``core`` of the group that is nearest in Mahalanobis
distance, take its mean and covariance, and so on until no determinant falls. The start with the least one wins. Distances
are scaled by the core's border, and a text beyond the 0.9999 quantile of chi-square is rejected.

Each variance is increased by the square of the statistic's FLOORS, so that groups whose core does not vary at all (no
symbols anywhere, or one text many times over) reject nothing ordinary. Each floor is so low that its statistic alone can
reject: if the core does not vary, words longer or shorter by a quarter, a symbol in five words, half of the lines
repeated, or 15 % of the words in repeated windows are beyond the cut.

Grid values make all sums exact and every order statistic a count over a few thousand values: results do not depend on
how rows are spread, and no group meets in one task. Texts of a group with fewer than ``least`` texts that pass the fixed
limits are judged by the estimate of their language, and by that of all texts if it has too few as well.

Defined results: a null text has no words and fails. Null languages and sources are groups like any other. Every row
gives one row, also rows that repeat or lack a doc_id. Other columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .storage import broadcast_up_to, stored

SPACE = r"[\x09-\x0D\x20]+"
BLANK = "\t\n\x0b\x0c\r "
SYMBOLS = r"[^#*$%&|<>]+"
WINDOW = 8
GRID = 0.001
#: ln mean word length, ln(1 + symbols per word), share of repeated lines, share of words in repeated windows
STATISTICS = ("x1", "x2", "x3", "x4")
FLOORS = (0.05, 0.04, 0.1, 0.03)
#: quantiles of chi-square with four degrees of freedom
CHI_CORE = {0.75: 5.385}
CHI_CUT = 23.513
SMALL_GROUPS = 20_000
STARTS = (0.5, 0.25, 0.75)  # quantiles
TOP = 4095  # distances are counted in this many classes, equal on a logarithmic scale


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value worked out once."""
    return F.get(F.transform(F.array(value), body), 0)


def repeated_words(hashes: Column) -> Column:
    """Words covered by windows of WINDOW (1, 2, 4, 8) words that occur more than once."""
    at = lambda a, i: F.get(a, i.cast("int"))

    def doubled(h: Column, step: int) -> Column:
        """From hashes of runs of ``step`` words to those of runs twice as long."""
        n = F.size(h) - step
        both = F.zip_with(F.slice(h, 1, n), F.slice(h, step + 1, n), lambda x, y: F.xxhash64(x, y))
        return F.when(n > 0, both).otherwise(F.array().cast("array<bigint>"))

    def covered(places: Column) -> Column:
        return F.aggregate(
            F.transform(places, lambda p, j: F.least(F.lit(WINDOW), F.coalesce(at(places, j + 1) - p, F.lit(WINDOW)))),
            F.lit(0),
            lambda a, x: a + x,
        )

    def twice(pairs: Column) -> Column:
        same = lambda x, y: F.coalesce(x["h"] == y["h"], F.lit(False))
        kept = F.filter(pairs, lambda x, j: same(x, at(pairs, j - 1)) | same(x, at(pairs, j + 1)))
        return F.array_sort(F.transform(kept, lambda x: x["i"]))

    def count(w: Column) -> Column:
        pairs = F.sort_array(F.transform(w, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(w)) == F.size(w), 0).otherwise(_let(_let(pairs, twice), covered))

    return _let(_let(_let(doubled(hashes, 1), lambda h: doubled(h, 2)), lambda h: doubled(h, 4)), count)


def base_statistics(text: Column) -> list[Column]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines of a text."""
    whole = F.coalesce(text, F.lit(""))
    bare = F.btrim(whole, F.lit(BLANK))
    words = F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, SPACE))
    lines = F.filter(F.split(whole, "\n"), lambda x: F.btrim(x, F.lit(BLANK)) != "")
    return [
        F.size(words).cast("long").alias("n_words"),
        F.length(F.regexp_replace(whole, SPACE, "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace(whole, SYMBOLS, "")).cast("long").alias("n_symbols"),
        _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        _let(F.transform(words, lambda w: F.xxhash64(w)), repeated_words).cast("long").alias("n_repeat_words"),
        F.size(lines).cast("long").alias("n_lines"),
    ]


def statistics(docs: DataFrame, id_col: str, text_col: str, lang_col: str, source_col: str) -> DataFrame:
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(lang_col).cast("string").alias("lang"),
        F.col(source_col).cast("string").alias("source"),
        *base_statistics(F.col(text_col).cast("string")),
    )
    n = F.greatest(F.col("n_words"), F.lit(1))
    vector = [
        F.log(F.greatest(F.col("word_chars"), F.lit(1)) / n),
        F.log1p(F.col("n_symbols") / n),
        F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)),
        F.col("n_repeat_words") / n,
    ]
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    grid = [F.round(x / GRID).cast("long").alias(name) for x, name in zip(vector, STATISTICS)]
    # a key that is never null, for joins by group
    group = F.sha2(F.to_json(F.struct("lang", "source"), {"ignoreNullFields": "false"}), 256)
    return rows.withColumn("base_failed", failed).select("*", *grid, group.alias("group"))


def _by_group(df: DataFrame) -> DataFrame:
    """A stored table with one row for each group, broadcast while it is small: a hot group's rows then stay where they are."""
    return broadcast_up_to(stored(df, "groups"), SMALL_GROUPS)


def _squared(own: list[Column], mean: list[Column], root: dict[tuple[int, int], Column]) -> Column:
    """Squared Mahalanobis distance by forward substitution with a Cholesky factor."""
    total, z = F.lit(0.0), []
    for i, x in enumerate(own):
        left = x - mean[i]
        for j in range(i):
            left = left - root[i, j] * z[j]
        z.append(left / root[i, i])
        total = total + z[i] * z[i]
    return total


def _pairs() -> list[tuple[int, int]]:
    return [(i, j) for i in range(len(STATISTICS)) for j in range(i + 1)]


def _factored(estimate: DataFrame) -> DataFrame:
    """(group, m0.., l00, l10, l11, ..) from means and covariances c00, c10, ..; one column after another."""
    for i, j in _pairs():
        left = F.col(f"c{i}{j}") + (FLOORS[i] ** 2 if i == j else 0.0)
        for k in range(j):
            left = left - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
        # floors keep pivots above zero; rounding can't bring them below a millionth of the floor
        value = F.sqrt(F.greatest(left, F.lit(FLOORS[i] ** 2 * 1e-6))) if i == j else left / F.col(f"l{j}{j}")
        estimate = estimate.withColumn(f"l{i}{j}", value)
    return estimate.drop(*[f"c{i}{j}" for i, j in _pairs()])


def _distanced(rows: DataFrame, estimate: DataFrame, how: str = "inner") -> DataFrame:
    mean = [F.col(f"m{i}") for i in range(len(STATISTICS))]
    root = {p: F.col(f"l{p[0]}{p[1]}") for p in _pairs()}
    d2 = _squared([F.col(x) * GRID for x in STATISTICS], mean, root)
    return rows.join(estimate, "group", how).withColumn("d2", d2).drop(*[f"m{i}" for i in range(len(mean))], *[f"l{i}{j}" for i, j in root])


def _class(d2: Column) -> Column:
    return F.least(F.lit(TOP), F.floor(F.log1p(d2) * 256)).cast("int")


def _started(rows: DataFrame) -> DataFrame:
    """Quartiles as centres and scaled median absolute deviations without correlations, under ``group`` and start."""
    centres = F.percentile  # exact: grid values are counted
    middle = rows.groupBy("group").agg(*[centres(x, F.array(*map(F.lit, STARTS))).alias(f"q{i}") for i, x in enumerate(STATISTICS)])
    middle = _by_group(middle)
    off = rows.join(middle, "group").select("group", *[F.abs(F.col(x) - F.round(F.col(f"q{i}")[0])).alias(x) for i, x in enumerate(STATISTICS)])
    spread = off.groupBy("group").agg(*[F.percentile(x, 0.5).alias(f"s{i}") for i, x in enumerate(STATISTICS)])
    both = middle.join(spread, "group").withColumn("start", F.explode(F.sequence(F.lit(0), F.lit(len(STARTS) - 1))))
    return both.select(
        _started_key(F.col("start")).alias("group"),
        *[(F.element_at(f"q{i}", F.col("start") + 1) * GRID).alias(f"m{i}") for i in range(len(STATISTICS))],
        *[(F.pow(F.col(f"s{i}") * (GRID * 1.4826), F.lit(2.0)) if i == j else F.lit(0.0)).alias(f"c{i}{j}") for i, j in _pairs()],
    )


def _started_key(start: Column) -> Column:
    return F.concat(F.col("group"), F.lit("#"), start.cast("string"))


def _concentrated(rows: DataFrame, estimate: DataFrame, core: float) -> DataFrame:
    """Mean and covariance of the share ``core`` of each group that is nearest by ``estimate``."""
    near = _distanced(rows, estimate).withColumn("class", _class(F.col("d2")))
    limit = _by_group(near.groupBy("group").agg(F.percentile("class", core).alias("limit")))
    kept = near.join(limit, "group").where("class <= limit")
    wide = lambda c: F.sum(c.cast("decimal(19,0)"))
    sums = kept.groupBy("group").agg(
        F.count("*").alias("n"),
        *[wide(F.col(x)).alias(f"t{i}") for i, x in enumerate(STATISTICS)],
        *[wide(F.col(STATISTICS[i]) * F.col(STATISTICS[j])).alias(f"p{i}{j}") for i, j in _pairs()],
    )
    t = lambda i: F.col(f"t{i}").cast("double") / F.col("n")
    return sums.select(
        "group",
        *[(t(i) * GRID).alias(f"m{i}") for i in range(len(STATISTICS))],
        *[((F.col(f"p{i}{j}").cast("double") / F.col("n") - t(i) * t(j)) * GRID**2).alias(f"c{i}{j}") for i, j in _pairs()],
    )


def _log_determinant() -> Column:
    """Of the floored covariance, from its factor."""
    total = F.lit(0.0)
    for i in range(len(STATISTICS)):
        total = total + 2 * F.log(f"l{i}{i}")
    return total


def _least_determinant(rows: DataFrame, core: float, steps: int) -> DataFrame:
    """The estimate of each group of ``rows``: from every start until no determinant falls, then the least one."""
    everywhere = rows.withColumn("group", F.explode(F.array(*[_started_key(F.lit(i)) for i in range(len(STARTS))])))
    best = _by_group(_factored(_concentrated(everywhere, _by_group(_factored(_started(rows))), core)).withColumn("logdet", _log_determinant()))
    for _ in range(steps):
        new = _factored(_concentrated(everywhere, best.drop("logdet"), core)).withColumn("logdet", _log_determinant())
        old = best.select(*[F.col(c).alias(c if c == "group" else f"old_{c}") for c in best.columns])
        falls = F.col("logdet") < F.col("old_logdet") - 1e-9
        kept = [F.when(falls, F.col(c)).otherwise(F.col(f"old_{c}")).alias(c) for c in best.columns if c != "group"]
        best = stored(new.join(old, "group").select("group", *kept, falls.alias("falls")), "groups")
        fallen = best.where("falls").limit(1).count()
        best = broadcast_up_to(best.drop("falls"), SMALL_GROUPS)
        if not fallen:
            break
    values = [c for c in best.columns if c not in ("group", "logdet")]
    start = F.substring_index("group", "#", -1).cast("int")
    least = best.groupBy(F.substring_index("group", "#", 1).alias("group")).agg(F.min(F.struct("logdet", start.alias("start"), *values)).alias("e"))
    return least.select("group", *[F.col(f"e.{c}") for c in values])


def _assigned(able: DataFrame, least: int) -> DataFrame:
    """(group, judge, estimate, feeds): by whose estimate a group is judged, of which kind, and into which its texts go."""
    sizes = stored(able.groupBy("group", "language").count(), "sizes")
    spoken = sizes.groupBy("language").agg(F.sum("count").alias("spoken"), F.max(F.col("count") < least).alias("small"))
    rows = sizes.join(spoken, "language").withColumn("own", F.col("count") >= least)
    kind = F.when(F.col("own"), "group").when(F.col("spoken") >= least, "language").otherwise("all")
    rows = stored(rows.withColumn("estimate", kind), "kinds")
    by_all = rows.where("estimate = 'all'").limit(1).count() > 0
    judge = F.when(F.col("own"), F.col("group")).when(F.col("estimate") == "language", F.col("language")).otherwise(F.lit("all"))
    feeds = F.array_compact(F.array(
        F.when(F.col("own"), F.col("group")), F.when(F.col("small") & (F.col("spoken") >= least), F.col("language")), F.when(F.lit(by_all), F.lit("all"))
    ))
    return rows.select("group", judge.alias("judge"), "estimate", feeds.alias("feeds"))


def judged(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
    core: float = 0.75, steps: int = 12, least: int = 40,
) -> DataFrame:
    """(doc_id, lang, source, statistics, base_failed, d2, estimate, kept) of each row.

    ``d2`` is the squared distance, scaled so that the core's border lies where it does for normal data (never down).
    ``estimate`` says whose it is: that of the ``group``, its ``language`` or ``all``. Both are null where every text of
    the group fails the fixed limits.
    """
    every = stored(statistics(docs, id_col, text_col, lang_col, source_col), "statistics")
    language = F.sha2(F.to_json(F.struct("lang"), {"ignoreNullFields": "false"}), 256).alias("language")
    able = every.where("not base_failed").select("group", language, *STATISTICS)
    assigned = _by_group(_assigned(able, least))
    able = able.join(assigned.select("group", "feeds"), "group").select(F.explode("feeds").alias("group"), *STATISTICS)
    estimate = _by_group(_least_determinant(able, core, steps))
    border = _distanced(able, estimate).groupBy("group").agg(F.percentile(_class(F.col("d2")), core).alias("border"))
    scale = F.greatest(F.lit(1.0), F.expm1(F.col("border") / 256) / CHI_CORE[core])
    estimate = _by_group(estimate.join(border.select("group", scale.alias("scale")), "group"))
    placed = every.join(assigned.select("group", "judge", "estimate"), "group", "left").drop("group").withColumnRenamed("judge", "group")
    out = _distanced(placed, estimate, "left")
    out = out.withColumn("d2", F.col("d2") / F.col("scale")).drop("scale", "group")
    return out.withColumn("kept", ~F.col("base_failed") & F.coalesce(F.col("d2") <= CHI_CUT, F.lit(True)))
