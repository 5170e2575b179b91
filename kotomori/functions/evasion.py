"""Evasion signals: detect a trick, undo it, and weigh it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kotomori.config import LEXICON, LOOKALIKE_FROM, LOOKALIKE_TO, RISK, RiskWeights
from kotomori.functions.text import WORD_CHAR, nfkc

# The symbol comes first, so that only behind one the text around it is looked at. Java looks
# behind in whole code points only if the group names an astral one, so a letter that the
# class covers anyway is written out.
SYMBOL = r"[.·•*_\-|/\\]"
INSERTED_SYMBOL = rf"{SYMBOL}(?<=(?:{WORD_CHAR}|𠮷){SYMBOL})(?={WORD_CHAR})"
LONG_RUN = r"(?d)(.)\1{2,}"
JAPANESE = r"[\x{3040}-\x{30ff}\x{4e00}-\x{9fff}]"
CYRILLIC = r"[\x{400}-\x{4ff}]"

SIGNALS = ("had_fullwidth", "had_homoglyphs", "had_symbol_insertion", "had_elongation")


def fold_homoglyphs(c: Column) -> Column:
    return F.translate(c, LOOKALIKE_FROM, LOOKALIKE_TO)


def strip_inserted_symbols(c: Column) -> Column:
    return F.regexp_replace(c, INSERTED_SYMBOL, "")


def collapse_elongation(c: Column) -> Column:
    """Three or more of the same character become two."""
    return F.regexp_replace(c, LONG_RUN, "$1$1")


def script_flags(c: Column) -> Column:
    japanese, latin = c.rlike(JAPANESE), c.rlike("[a-zA-Z]")
    return F.struct(
        japanese.alias("japanese"),
        latin.alias("latin"),
        c.rlike("[0-9]").alias("numerals"),
        c.rlike(CYRILLIC).alias("cyrillic"),
        (japanese & latin).alias("code_switching"),
    )


def lexicon_hits(c: Column, lexicon: tuple[str, ...] = LEXICON) -> Column:
    """The lexicon patterns found, in lexicon order."""
    return F.array_compact(F.array(*[F.when(c.rlike(p), F.lit(p)) for p in lexicon]))


def risk_score(weights: RiskWeights = RISK) -> Column:
    """Risk from the columns of :func:`with_evasion`; the order of the sum is fixed
    because the threshold is compared with sums of doubles."""

    def part(condition: Column, weight: float) -> Column:
        return F.when(condition, F.lit(weight)).otherwise(F.lit(0.0))

    hits = F.least(F.size("abuse_patterns_found"), F.lit(weights.lexicon_hits_counted))
    total = (
        part(F.col("had_fullwidth"), weights.fullwidth)
        + part(F.col("had_homoglyphs"), weights.homoglyphs)
        + part(F.col("had_symbol_insertion"), weights.symbol_insertion)
        + part(F.col("had_elongation"), weights.elongation)
        + part(F.col("script_info.cyrillic"), weights.cyrillic)
        + hits.cast("double") * F.lit(weights.lexicon_hit)
    )
    return F.least(total, F.lit(weights.cap))


def with_evasion(
    df: DataFrame,
    text: str,
    weights: RiskWeights = RISK,
    lexicon: tuple[str, ...] = LEXICON,
    where: Column | str | None = None,
) -> DataFrame:
    """Add ``normalized``, ``original_length``, the signals, ``script_info``,
    ``abuse_patterns_found`` and ``risk``.

    The chain is one struct, each step of which sees the one before by name. Its first
    step calls Java, which Spark takes for non-deterministic, so a filter on any of
    these columns is neither pushed into the chain nor makes Spark repeat it. Nor does a
    filter on other columns get past it: rows that a condition on the input leaves out go
    by ``where``, ahead of the chain, from where it reaches the scan.
    """
    df = df if where is None else df.where(where)
    wide = F.transform(F.array(nfkc(F.col(text))), lambda w: F.struct(w.alias("wide"), fold_homoglyphs(w).alias("folded")))
    joined = F.transform(wide, lambda x: F.struct(x["wide"].alias("wide"), x["folded"].alias("folded"), strip_inserted_symbols(x["folded"]).alias("joined")))
    chain = F.transform(joined, lambda x: F.struct(x["wide"].alias("wide"), x["folded"].alias("folded"), x["joined"].alias("joined"), collapse_elongation(x["joined"]).alias("normalized")))
    return (
        df.withColumn("_chain", F.get(chain, F.lit(0)))
        .withColumns(
            {
                "normalized": F.col("_chain.normalized"),
                "original_length": F.char_length(text),
                "had_fullwidth": F.col("_chain.wide") != F.col(text),
                "had_homoglyphs": F.col("_chain.folded") != F.col("_chain.wide"),
                "had_symbol_insertion": F.col("_chain.joined") != F.col("_chain.folded"),
                "had_elongation": F.col("_chain.normalized") != F.col("_chain.joined"),
                "script_info": script_flags(F.col("_chain.normalized")),
                "abuse_patterns_found": lexicon_hits(F.col("_chain.normalized"), lexicon),
            }
        )
        .drop("_chain")
        .withColumn("risk", risk_score(weights))
    )


def flags_map() -> Column:
    """Only the signals that are true, as a map."""
    pairs = [x for s in SIGNALS for x in (F.lit(s), F.col(s))]
    return F.map_filter(F.create_map(*pairs), lambda _, v: v)


def row_flags() -> Column:
    """Names for the documented record: any trick seen, scripts mixed."""
    tricked = F.greatest(*[F.col(s) for s in SIGNALS])
    return F.array_compact(
        F.array(
            F.when(tricked, F.lit("adversarial_text_detected")),
            F.when(F.col("script_info.code_switching"), F.lit("code_switching")),
        )
    )
