"""Mixing sources to target weights by iterative proportional fitting. DataFrame code only.

Documents fall into cells (source, language, topic). Raking multiplies the cells' token
weights in turn so that the sums by source, by language and by topic meet their targets.
A cell's factor, weight over tokens, times a scale is the expected number of copies of each
of its documents, so expected token shares are the targets. The draw is a hash of the
document's id: it repeats on every run.

The scale brings the largest factor to 1 where the sample then holds ``LEAST_SHARE`` of the
tokens, else it is that share: one rare cell does not thin out the sample. A document with
an expectation above 1 is repeated, at most ``MOST_COPIES`` times; ``weight`` carries what
that bound cuts off (1 without a cut).

The cell table is far smaller than the corpus: one pass over the documents builds it, with
map-side combine, and the rounds run on it: a window sums the weights of each value of a
margin beside its cells, so a step is one shuffle of that table and no join. A few rounds
at a time are written and read back, so plans stay short and a lost executor repeats little.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardline.operators.store import materialize

MARGINS = ("source", "lang", "topic")
# Targets where none are given: shares of the tokens to these powers, brought to sum 1.
POWERS = {"source": 0.7, "lang": 0.8, "topic": 0.9}
ROUNDS = 8
# Share of the tokens that a sample holds at least, in expectation.
LEAST_SHARE = 0.5
# A document is repeated so often at most.
MOST_COPIES = 16
# Rounds between two writes of the cell table.
ROUNDS_WRITTEN = 4
WORDS = r"[^\x20\x09-\x0D]+"
# First match wins; patterns over the whole text, whatever the case of A-Z.
TOPICS = (("legal", "licen[cs]e|copyright|rights reserved"), ("contact", "@|phone|www[.]"), ("numeric", "[0-9]{4}"))
OTHER = "prose"
_UNIT = 1 << 52


def described(docs: DataFrame) -> DataFrame:
    """``docs`` with the cell columns ``m_source, m_lang, m_topic`` and ``n_tokens``.

    Tokens are words without ASCII white space. Null sources and languages form a cell value
    of their own, the empty text; null texts have no tokens and the topic of other texts.
    """
    text = F.coalesce("text", F.lit(""))
    topic: Column = F.lit(OTHER)
    for name, pattern in reversed(TOPICS):
        topic = F.when(text.rlike(f"(?i){pattern}"), F.lit(name)).otherwise(topic)
    return docs.withColumns({
        "m_source": F.coalesce(F.col("source").cast("string"), F.lit("")),
        "m_lang": F.coalesce(F.col("lang").cast("string"), F.lit("")),
        "m_topic": topic,
        "n_tokens": F.regexp_count(text, F.lit(WORDS)).cast("bigint"),
    })


def default_targets(cells: DataFrame, margin: str) -> DataFrame:
    """Tempered shares: ``m_<margin>, target``, summing to 1."""
    sums = cells.groupBy(f"m_{margin}").agg(F.sum("tokens").alias("tokens"))
    powered = sums.select(f"m_{margin}", F.pow(F.col("tokens").cast("double"), F.lit(POWERS[margin])).alias("power"))
    total = powered.agg(F.sum("power")).first()[0]
    return powered.select(f"m_{margin}", (F.col("power") / F.lit(total or 1.0)).alias("target"))


def _held(margin: str) -> Column:
    """Weight of all cells that share this cell's value of a margin."""
    return F.sum("weight").over(Window.partitionBy(f"m_{margin}"))


def calibrate(rows: DataFrame, targets: Mapping[str, DataFrame] | None = None, rounds: int = ROUNDS) -> DataFrame:
    """Cells of ``described`` rows with ``tokens, factor, expected, residual``.

    ``targets`` may give, by margin, a table ``m_<margin>, target``; a value it lacks is not
    wanted and gets weight 0. Cells without tokens keep the factor 1. ``expected`` copies are
    the factor times the scale. ``residual`` is how far, at most, the sums of the cell's own
    source, language and topic are from their targets after the last round.
    """
    keys = [f"m_{m}" for m in MARGINS]
    cells = materialize(rows.groupBy(*keys).agg(F.sum("n_tokens").alias("tokens")), "mix-cells")
    total = float(cells.agg(F.sum("tokens")).first()[0] or 1)
    state = cells.withColumn("weight", F.col("tokens") / F.lit(total))
    for m in MARGINS:
        given = (targets or {}).get(m)
        wanted = (default_targets(cells, m) if given is None else given).select(f"m_{m}", F.col("target").alias(f"t_{m}"))
        state = state.join(wanted, f"m_{m}", "left").withColumn(f"t_{m}", F.coalesce(f"t_{m}", F.lit(0.0)))
    state = materialize(state, "mix-round")
    for number in range(rounds):
        for m in MARGINS:
            held = state.withColumn("held", _held(m))
            ratio = F.when(F.col("held") > 0, F.col(f"t_{m}") / F.col("held")).otherwise(1.0)
            state = held.withColumn("weight", F.col("weight") * ratio).drop("held")
        if (number + 1) % ROUNDS_WRITTEN == 0 or number + 1 == rounds:
            state = materialize(state, "mix-round")
    off = F.greatest(*[F.abs(_held(m) - F.col(f"t_{m}")) for m in MARGINS])
    factor = F.when(F.col("tokens") > 0, F.col("weight") * total / F.col("tokens"))
    found = materialize(state.select(*keys, "tokens", factor.alias("factor"), off.alias("residual")), "mix-factors")
    top = found.agg(F.max("factor")).first()[0] or 1.0
    # Tokens times factors sum to all tokens, so a scale of the factors is the share kept.
    scale = max(1.0 / top, LEAST_SHARE)
    factor = F.coalesce("factor", F.lit(1.0))
    return found.select(*keys, "tokens", factor.alias("factor"), (factor * F.lit(scale)).alias("expected"), "residual")


def draw(seed: str = "mix") -> Column:
    """A number in [0, 1) from the document's id; a null id counts as the empty text."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("bigint") / F.lit(_UNIT)


def copies() -> Column:
    """How often the draw keeps a document: whole copies, and one more by the fraction."""
    bounded = F.least(F.col("expected"), F.lit(float(MOST_COPIES)))
    whole = F.floor(bounded)
    return whole + (draw() < bounded - whole).cast("bigint")


def mix(rows: DataFrame, cells: DataFrame) -> DataFrame:
    """``described`` rows with ``factor, expected, weight`` and ``copies``, the outcome."""
    keys = [f"m_{m}" for m in MARGINS]
    joined = rows.join(cells.select(*keys, "factor", "expected"), keys)
    return joined.withColumns({"copies": copies(), "weight": F.greatest(F.col("expected") / F.lit(float(MOST_COPIES)), F.lit(1.0))})


def mix_documents(docs: DataFrame) -> DataFrame:
    """``doc_id, source, lang, topic, n_tokens, factor, expected, copies, weight, kept`` of
    every document.

    Repeated rows share their draw. An empty table gives no rows.
    """
    narrow = described(docs.select("doc_id", "text", "source", "lang")).drop("text", "source", "lang")
    rows = materialize(narrow, "mix-documents")
    found = mix(rows, calibrate(rows))
    rounded = [F.round(c, 6).alias(c) for c in ("factor", "expected")]
    return found.select(
        "doc_id", *[F.col(f"m_{m}").alias(m) for m in MARGINS], "n_tokens", *rounded, "copies",
        F.round("weight", 6).alias("weight"), (F.col("copies") > 0).alias("kept"),
    )


def sample_documents(docs: DataFrame) -> DataFrame:
    """The documents that the draw keeps, as often as it does; columns unchanged.

    Repeats are rows with the same ``doc_id``; the weights beyond ``MOST_COPIES`` are those
    of ``mix_documents``.
    """
    # The rows as they came, apart from the columns made here.
    rows = described(docs.select(F.struct(*docs.columns).alias("m_row"), "doc_id", "text", "source", "lang"))
    keys = [f"m_{m}" for m in MARGINS]
    cells = calibrate(rows.select(*keys, "n_tokens"))
    drawn = rows.join(cells.select(*keys, "expected"), keys).select("m_row", copies().cast("int").alias("m_copies"))
    return drawn.where("m_copies > 0").select("m_row", F.explode(F.array_repeat(F.lit(True), F.col("m_copies")))).select("m_row.*")
