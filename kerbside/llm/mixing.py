"""Mixing sources to target weights by iterative proportional fitting (raking).

Tokens are counted per source, language and topic. Weights f_source * f_language * f_topic are raked
until the weighted tokens meet all three target marginals; a document's probability to be drawn is its
weight times one factor, at most 1, with the factor set so that the expected tokens meet the budget.

Languages and topics are closed lists; sources are not. Each source is one row of token counts by
(language, topic), and a sweep is one aggregation over these rows: given the other factors a source's
own factor follows in place, and only a (language x topic) table of sums reaches the driver.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.llm.tokens import blocks, encoded, kinds, words_of
from kerbside.session import stage

LANGUAGES = ("en", "de", "fr", "es")
TOPICS = 8
_TABLE = kinds(b"0123456789abcdefghijklmnopqrstuvwxyz" + bytes(range(128, 256)))


def token_and_topic(text: Column) -> Column:
    """struct(tokens, topic): words of a text, and which of TOPICS word groups most of its words of four
    bytes or more fall into (ties: the lower; none: 0). Stands in where the table has no topic column."""

    @F.pandas_udf("tokens bigint, topic int")
    def measure(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            tokens, topic = [], []
            for block in blocks([encoded(t).lower() for t in batch]):
                words = words_of(block, _TABLE)
                tokens.append(np.bincount(words.owner, minlength=words.n_texts))
                long = words.end - words.start >= 4
                group = (words.hash[long] % np.uint64(TOPICS)).astype(np.int64)
                table = np.bincount(words.owner[long] * TOPICS + group, minlength=words.n_texts * TOPICS)
                topic.append(table.reshape(-1, TOPICS).argmax(1))
            yield pd.DataFrame({"tokens": np.concatenate(tokens), "topic": np.concatenate(topic)}) if tokens else pd.DataFrame(
                {"tokens": [], "topic": []}
            )

    return measure(text)


#: Sweeps in a row without progress after which targets count as contradicting each other.
STALLED = 3


@dataclass
class Mixture:
    """The raked factors. ``sources`` has (source, source_factor); the other two are small lists."""

    sources: DataFrame
    language: np.ndarray
    topic: np.ndarray
    scale: float
    sweeps: int
    gap: float  # the most by which a language's or topic's share misses its target; sources meet theirs
    converged: bool


def language_index(lang: Column) -> Column:
    """Place in LANGUAGES; one further class for all others and NULL."""
    out = F.lit(len(LANGUAGES))
    for i, name in enumerate(LANGUAGES):
        out = F.when(lang == name, F.lit(i)).otherwise(out)
    return out


def _flattened(totals: np.ndarray, power: float) -> np.ndarray:
    goal = np.where(totals > 0, totals, 0) ** power * (totals > 0)
    return goal / goal.sum() if goal.sum() else goal


def rake(
    counted: DataFrame,
    power: float = 0.5,
    language_target: np.ndarray | None = None,
    topic_target: np.ndarray | None = None,
    budget_share: float = 0.5,
    tolerance: float = 1e-6,
    max_sweeps: int = 100,
) -> Mixture:
    """Factors from (source, language, topic, tokens) rows; language and topic are indexes.

    Targets: shares of tokens. Without explicit ones they are the observed shares raised to ``power``,
    which lifts the small ones; sources always follow that rule. Cells without tokens stay empty.
    ``budget_share`` of all tokens are to be drawn, as far as there are enough.

    Targets may contradict each other, as where sources of one language each have other shares than their languages.
    Where STALLED sweeps in a row lower the gap by less than 1 % each, sweeping stops: sources meet their shares exactly,
    languages and topics as nearly as ``gap`` says, ``converged`` is false and a warning names the gap. The same
    holds after ``max_sweeps``.
    """
    n_lang, k = len(LANGUAGES) + 1, (len(LANGUAGES) + 1) * TOPICS
    cell = (F.col("language") * TOPICS + F.col("topic")).cast("int")
    cells = counted.groupBy("source", cell.alias("cell")).agg(F.sum("tokens").cast("double").alias("tokens")).where("tokens > 0")
    per_source = stage(
        cells.groupBy("source").agg(
            F.array_sort(F.collect_list(F.struct("cell", "tokens"))).alias("cells"),  # k entries at most
            F.sum("tokens").alias("own"),
        ),
        "mixing_sources",
    )

    def by_cell(rows: DataFrame, value: Column) -> np.ndarray:
        """Sum of ``value`` over all sources, per cell of the (language x topic) table."""
        sums = rows.select("*", F.inline("cells")).groupBy("cell").agg(F.sum(value).alias("v"))
        table = np.zeros(k)
        for r in sums.collect():  # k rows at most
            table[r.cell] = r.v
        return table.reshape(n_lang, TOPICS)

    table = by_cell(per_source, F.col("tokens"))
    total = table.sum()
    shares = per_source.agg(F.sum(F.pow("own", F.lit(power)))).first()[0]
    goal_s = F.pow("own", F.lit(power)) / F.lit(float(shares or 1))
    goal_l = _flattened(table.sum(1), power) if language_target is None else _present(language_target, table.sum(1))
    goal_t = _flattened(table.sum(0), power) if topic_target is None else _present(topic_target, table.sum(0))
    f_l, f_t = np.ones(n_lang), np.ones(TOPICS)

    def with_factor() -> DataFrame:
        """Sources with the factor that meets their own target under the other factors."""
        phi = F.array(*[F.lit(float(x)) for x in np.outer(f_l, f_t).ravel()])
        weighed = F.aggregate("cells", F.lit(0.0), lambda s, c: s + c["tokens"] * F.get(F.col("phi"), c["cell"]))
        return (
            per_source.select("*", phi.alias("phi"))
            .select("*", weighed.alias("weighed"))
            .withColumn("source_factor", F.when(F.col("weighed") > 0, goal_s / F.col("weighed")).otherwise(F.lit(0.0)))
        )

    sweeps, gap, stalled = 0, 0.0, 0
    for sweeps in range(1, max_sweeps + 1) if total else ():
        sums = by_cell(with_factor(), F.col("source_factor") * F.col("tokens"))  # raked over sources only
        raked = sums * np.outer(f_l, f_t)
        before, gap = gap, max(float(np.abs(raked.sum(1) - goal_l).max()), float(np.abs(raked.sum(0) - goal_t).max()))
        stalled = stalled + 1 if sweeps > 1 and gap > 0.99 * before else 0
        if gap < tolerance or stalled == STALLED:
            break
        by_l = sums @ f_t
        f_l = np.divide(goal_l, by_l, out=np.zeros_like(goal_l), where=by_l > 0)
        by_t = f_l @ sums
        f_t = np.divide(goal_t, by_t, out=np.zeros_like(goal_t), where=by_t > 0)
    converged = gap < tolerance
    if not converged:
        warnings.warn(f"targets not met after {sweeps} sweeps: shares of languages or topics miss by up to {gap:.2g}", stacklevel=2)
    sources = stage(with_factor().drop("phi", "weighed"), "mixing_factors")

    # One factor for all: tokens of cells drawn whole, plus scale times the weight of the rest, meet the budget.
    budget, scale = budget_share * total, budget_share * total
    phi = F.array(*[F.lit(float(x)) for x in np.outer(f_l, f_t).ravel()])
    weights = sources.select("source_factor", F.inline("cells")).select(
        "tokens", (F.col("source_factor") * F.get(phi, F.col("cell"))).alias("g")
    )
    for _ in range(50 if total else 0):
        whole = F.col("g") * F.lit(float(scale)) >= 1
        r = weights.agg(
            F.sum(F.when(whole, F.col("tokens")).otherwise(0.0)).alias("whole"),
            F.sum(F.when(whole, 0.0).otherwise(F.col("tokens") * F.col("g"))).alias("rest"),
        ).first()
        if not r.rest or r.whole >= budget:
            break
        new = (budget - r.whole) / r.rest
        if new <= scale * (1 + 1e-9):
            break
        scale = new
    return Mixture(sources.select("source", "source_factor"), f_l, f_t, scale, sweeps, gap, converged)


def _present(goal: np.ndarray, observed: np.ndarray) -> np.ndarray:
    goal = np.asarray(goal, dtype=float) * (observed > 0)
    return goal / goal.sum() if goal.sum() else goal


def _probability(mixture: Mixture) -> Column:
    phi = F.array(*[F.lit(float(x)) for x in np.outer(mixture.language, mixture.topic).ravel()])
    weight = F.col("source_factor") * F.get(phi, F.col("language") * TOPICS + F.col("topic"))
    return F.least(F.lit(1.0), weight * F.lit(float(mixture.scale)))


def _uniform(seed: int) -> Column:
    """A number from 0 to 1 for each document, by its id and text, so that rows that share an id are drawn one by one."""
    key = F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("text"))
    return F.pmod(key, F.lit(1 << 52)) / F.lit(float(1 << 52))


def mix_sources(documents: DataFrame, seed: int = 11, **targets) -> DataFrame:
    """(doc_id, source, lang, topic, tokens, probability, kept) of every row of ``documents``.

    NULL sources are a source of their own; NULL and unlisted languages share one class; documents
    without words have no tokens to weigh and follow their cell. Copies of a row are drawn or left together.
    Columns of ``documents`` other than doc_id, text, source and lang are not read.
    """
    counted = stage(
        documents.select("doc_id", "source", "lang", token_and_topic(F.col("text")).alias("m"), _uniform(seed).alias("u")).select(
            "doc_id", "source", "lang", language_index(F.col("lang")).alias("language"), "m.topic", "m.tokens", "u"
        ),
        "mixing_documents",
    )
    mixture = rake(counted, **targets)
    factors = mixture.sources.withColumnRenamed("source", "_source")
    return (
        counted.join(factors, counted["source"].eqNullSafe(factors["_source"]), "left")
        .withColumn("probability", F.coalesce(_probability(mixture), F.lit(0.0)))
        .select("doc_id", "source", "lang", "topic", "tokens", "probability", (F.col("u") < F.col("probability")).alias("kept"))
    )


def sample_mixture(documents: DataFrame, seed: int = 11, **targets) -> DataFrame:
    """The documents drawn, with all their columns; the same draw as ``mix_sources``."""
    measured = token_and_topic(F.col("text"))
    counted = stage(
        documents.select("source", language_index(F.col("lang")).alias("language"), measured.alias("m"))
        .select("source", "language", "m.topic", "m.tokens")
        .groupBy("source", "language", "topic")
        .agg(F.sum("tokens").alias("tokens")),
        "mixing_cells",
    )
    mixture = rake(counted, **targets)
    factors = mixture.sources.select(F.col("source").alias("_source"), "source_factor")
    inner = documents.select(F.struct(*[documents[c] for c in documents.columns]).alias("row"))
    described = inner.select(
        "row",
        F.col("row.source").alias("_own_source"),
        language_index(F.col("row.lang")).alias("language"),
        token_and_topic(F.col("row.text"))["topic"].alias("topic"),
        F.col("row.doc_id").alias("doc_id"),
        F.col("row.text").alias("text"),
    ).withColumn("_u", _uniform(seed))
    joined = described.join(factors, described["_own_source"].eqNullSafe(factors["_source"]), "left")
    return joined.where(F.col("_u") < F.coalesce(_probability(mixture), F.lit(0.0))).select("row.*")
