"""From file names to ensemble members."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isospread import registry
from isospread.functions import text
from isospread.registry import CASE_DELIMITER, Ensemble, resolve_ensemble
from isospread.sources.storage import broadcast_if_small, settle

#: Characters of a gram by which a longer text is looked up.
GRAM = 8


def keep_containing(df: DataFrame, column: str, token: str) -> DataFrame:
    """Rows whose text contains ``token``: literal, case-sensitive, anywhere."""
    return df.filter(F.contains(F.col(column), F.lit(token)))


def drop_containing(df: DataFrame, column: str, token: str) -> DataFrame:
    return df.filter(~F.contains(F.col(column), F.lit(token)))


def keep_extension(files: DataFrame) -> DataFrame:
    """Names with ``.nc`` anywhere, so ``a.nc.tmp`` stays."""
    return keep_containing(files, "fname", ".nc")


def keep_prefix(files: DataFrame, prefix: str = "b") -> DataFrame:
    return files.filter(F.startswith(F.col("fname"), F.lit(prefix)))


def keep_ensemble_token(files: DataFrame, ensemble: str | Ensemble) -> DataFrame:
    """Names that belong to the ensemble; an empty token keeps everything."""
    token = resolve_ensemble(ensemble).name_filter
    return keep_containing(files, "fname", token) if token else files


def keep_by_token_list(files: DataFrame, ensemble: str | Ensemble) -> DataFrame:
    """Names with any of the ensemble's tokens, or without all of them, by its flag."""
    ens = resolve_ensemble(ensemble)
    if not ens.file_tokens:
        raise ValueError(f"{ens.name} has no token list")
    tokens = F.array(*map(F.lit, ens.file_tokens))
    found = F.exists(tokens, lambda token: F.contains(F.col("fname"), token))
    return files.filter(found if ens.keep_file_tokens else ~found)


def keep_timestr(files: DataFrame, timestr: str | None) -> DataFrame:
    """Paths that contain the time string; ``None`` or ``NONE`` keeps everything."""
    if timestr is None or timestr.upper() == "NONE":
        return files
    return keep_containing(files, "path", timestr)


def keep_variables(df: DataFrame, variables: Iterable[str]) -> DataFrame:
    return df.filter(F.col("var").isin(list(variables)))


def case_names(files: DataFrame, ensemble: str | Ensemble) -> DataFrame:
    """Distinct case names of an ensemble's files (``fname`` column).

    A name that passes the filters but lacks the left splitter raises.
    """
    ens = resolve_ensemble(ensemble)
    kept = keep_ensemble_token(keep_prefix(keep_extension(files)), ens)
    name = text.case_name(F.col("fname"), ens.split_left, ens.split_right)
    return kept.select(name.alias("casename")).distinct()


def _grams(df: DataFrame, column: str, lengths: Column) -> DataFrame:
    """A row for each place and each of the ``lengths``, with the hash of the text there."""
    whole = F.col(column)
    return (
        df.withColumn("_length", F.explode(lengths))
        .filter(F.length(whole) >= F.col("_length"))
        .withColumn("_place", F.explode(F.sequence(F.lit(1), F.length(whole) - F.col("_length") + 1)))
        .withColumn("_gram", F.xxhash64(F.substring(whole, F.col("_place"), F.col("_length"))))
        .drop("_length", "_place")
    )


def contains_pairs(
    hay: DataFrame, hay_column: str, needles: DataFrame, needle_column: str, on: Iterable[str] = ()
) -> DataFrame:
    """Join distinct rows of ``hay`` to the distinct ``needles`` their text contains.

    ``contains`` alone is no join key, so it would compare every row with every needle. Each
    needle is instead indexed by that one of its grams of ``GRAM`` characters which is rarest in
    ``hay``, or by the whole of a shorter needle; a needle with a gram that is nowhere in ``hay``
    is left out at once. Texts are cut into grams of the same lengths, and equal grams give
    candidates, whose text is fetched by its hash and tested. Cut rows and candidates carry
    hashes rather than texts; since the text itself is tested, hashes that clash cost time only.

    A pair comes out once for each place of its gram. Missing texts and empty needles match nothing.
    The lengths, at most ``GRAM`` numbers, are looked up first, so pass the needles settled; the
    index is settled here, and broadcast only if it is small. A catalogue is small in bytes but
    grows while it is cut, so it is settled too, spread over all shuffle partitions.
    """
    on = [*on]
    wanted = needles.filter(F.length(needle_column) > 0).withColumn(
        "_cut", F.least(F.length(needle_column), F.lit(GRAM))
    )
    found = wanted.agg(F.collect_set("_cut").alias("lengths")).first().lengths
    lengths = F.array(*map(F.lit, sorted(found))).cast("array<int>")

    tasks = int(hay.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    texts = settle(hay.distinct().withColumn("_row", F.xxhash64(hay_column)).repartition(tasks, "_row"))
    cut = _grams(texts, hay_column, lengths).select(*on, "_row", "_gram")
    counts = cut.groupBy(*on, "_gram").agg(F.count("*").alias("_n"))
    rarest = F.min(F.struct(F.coalesce("_n", F.lit(0)).alias("n"), F.col("_gram").alias("gram")))
    index = (
        _grams(wanted, needle_column, F.array("_cut"))
        .join(counts, [*on, "_gram"], "left")
        .groupBy(*needles.columns)
        .agg(rarest.alias("_rarest"))
        .filter("_rarest.n > 0")
        .select(*needles.columns, F.col("_rarest.gram").alias("_gram"))
    )
    candidates = cut.join(broadcast_if_small(settle(index)), [*on, "_gram"]).drop("_gram")
    return (
        candidates.join(texts, [*on, "_row"])
        .filter(F.contains(F.col(hay_column), F.col(needle_column)))
        .drop("_row")
    )


def _glue(pairs: DataFrame, keys: list[str]) -> DataFrame:
    joined = F.array_join(F.array_sort(F.collect_list("case")), CASE_DELIMITER)
    return pairs.groupBy(*keys).agg(joined.alias("casename")).select("casename")


def _pair_within(
    cases: DataFrame, keys: list[str], match: str, skip_prefix: str | None = None
) -> DataFrame:
    """Glue the cases of each member number, within ``keys``.

    By default a number gathers every case that contains it anywhere; ``exact`` compares it
    with the trailing number only. Numbers with ``skip_prefix`` form no case of their own.
    """
    wanted = cases.withColumn("number", text.case_number(F.col("case")))
    if skip_prefix is not None:
        wanted = wanted.filter(~F.startswith(F.col("number"), F.lit(skip_prefix)))
    if match == "exact":
        return _glue(wanted, [*keys, "number"])
    numbers = wanted.select(*keys, "number").distinct()
    pairs = contains_pairs(cases, "case", numbers, "number", keys).distinct()
    return _glue(pairs, [*keys, "number"])


def pair_cases(
    cases: DataFrame, ensemble: str | Ensemble, match: str = "contains"
) -> DataFrame:
    """Glue historical and scenario runs of one member into one ``&&`` case name.

    The result is distinct ``casename`` rows. A glued name is the member's identity, one short
    string per member number. ``cases`` must be distinct, and should be settled.
    """
    if match not in ("contains", "exact"):
        raise ValueError(f"match must be 'contains' or 'exact', not {match!r}")
    ens = resolve_ensemble(ensemble)
    kept = cases.select("casename")
    for token in ens.drop_case_tokens:
        kept = drop_containing(kept, "casename", token)
    if ens.pairing is None:
        return kept.distinct()

    kept = kept.withColumnRenamed("casename", "case")
    if ens.pairing == "by_number":
        return _pair_within(kept, [], match, registry.SKIPPED_NUMBER_PREFIX).distinct()

    forcings = F.array(*map(F.lit, registry.PAIRED_FORCINGS))
    named = F.filter(forcings, lambda f: F.contains(F.col("case"), f))
    paired = _pair_within(kept.withColumn("forcing", F.explode(named)), ["forcing"], match)
    alone = keep_containing(kept, "case", registry.UNPAIRED_FORCING)
    return paired.unionByName(alone.withColumnRenamed("case", "casename")).distinct()


def case_numbers(cases: DataFrame) -> DataFrame:
    """Each case with its member number."""
    return cases.select("casename", text.case_number(F.col("casename")).alias("number"))


def catalog_counts(files: DataFrame, ensemble: str | Ensemble) -> DataFrame:
    """Files and distinct cases per variable."""
    ens = resolve_ensemble(ensemble)
    name: Column = text.case_name(F.col("fname"), ens.split_left, ens.split_right)
    kept = keep_ensemble_token(keep_prefix(keep_extension(files)), ens)
    return (
        kept.groupBy("var", name.alias("casename"))
        .agg(F.count("*").alias("n"))
        .groupBy("var")
        .agg(F.sum("n").alias("n_files"), F.count("*").alias("n_cases"))
    )
