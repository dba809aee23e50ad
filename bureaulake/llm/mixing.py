"""Sources mixed to target weights: iterative proportional fitting of token weights to source, language and topic marginals, then
a sample of documents by probabilities calibrated on them. DataFrame and SQL functions only.

A target names shares of categories; categories without one keep their share of the tokens, and all present ones are scaled to
one. Without a target, a marginal is tempered: shares go with the tokens to the power TEMPER. Within a cell (source, language,
topic) all documents have the same probability. It is in proportion to the weight of a token, scaled so that the sample has the
share ``keep`` of all tokens on average; cells that would need more than all their documents are taken whole.

A document's tokens are its words (runs of characters other than ``\\x20\\x09-\\x0D``). A null text has no word; a document without
words has no weight and isn't sampled. Null sources and languages are categories of their own. Sampling depends on the doc_id
alone, so repeated rows are taken together; a null doc_id counts as one id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bureaulake.llm.common import stored

MARGINALS = ("source", "lang", "topic")
TEMPER = 0.7
#: Share of the tokens that the sample has on average.
KEEP = 0.5
ROUNDS, STORE_EACH = 20, 5
NULL = "(null)"


def n_tokens(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def topic(text: str = "text") -> Column:
    """A coarse kind of content: tables, marked-up text, text with contacts or links, running text."""
    t = F.col(text)
    share = lambda marks: (F.char_length(t) - F.char_length(F.translate(t, marks, ""))) / F.greatest(F.char_length(t), F.lit(1))
    return (F.when(t.isNull(), NULL).when(share("|") > 0.02, "tables").when(share("#*$%&<>") > 0.05, "marked")
            .when(t.contains("@") | t.contains("://"), "contacts").otherwise("prose"))


def described(docs: DataFrame, *more: Column) -> DataFrame:
    """doc_id, the three categories and n_tokens of each row, and more columns."""
    return docs.select(*more, "doc_id", F.coalesce("source", F.lit(NULL)).alias("source"), F.coalesce("lang", F.lit(NULL)).alias("lang"), topic().alias("topic"),
                       n_tokens().alias("n_tokens"))


def _target(marginal: str, given: dict[str, float] | None) -> Column:
    """Unscaled target of each cell's category, the same for all its cells."""
    own = F.sum("tokens").over(Window.partitionBy(marginal))
    share = own / F.sum("tokens").over(Window.partitionBy(F.lit(0)))
    if given is None:
        return F.pow(share, F.lit(TEMPER))
    out = share
    for category, value in given.items():
        out = F.when(F.col(marginal) == category, F.lit(float(value))).otherwise(out)
    return out


def rake(documents: DataFrame, targets: dict[str, dict[str, float] | None], rounds: int = ROUNDS) -> DataFrame:
    """(source, lang, topic, tokens, weight) of each cell with tokens; the weights sum to one and meet the targets."""
    cells = stored(documents.where("n_tokens > 0").groupBy(*MARGINALS).agg(F.sum("n_tokens").alias("tokens")), "cells")
    for m in MARGINALS:
        cells = cells.withColumn(f"target_{m}", _target(m, targets.get(m)))
    for m in MARGINALS:  # one row of each category makes up the sum of the targets
        first = F.row_number().over(Window.partitionBy(m).orderBy(*MARGINALS)) == 1
        cells = cells.withColumn("one", F.when(first, F.col(f"target_{m}"))).withColumn(
            f"target_{m}", F.col(f"target_{m}") / F.sum("one").over(Window.partitionBy(F.lit(0)))).drop("one")
    cells = stored(cells.withColumn("weight", F.col("tokens") / F.sum("tokens").over(Window.partitionBy(F.lit(0)))), "raked")
    for k in range(rounds):
        for m in MARGINALS:
            cells = cells.withColumn("weight", F.col("weight") * F.col(f"target_{m}") / F.sum("weight").over(Window.partitionBy(m)))
        if k % STORE_EACH == STORE_EACH - 1 or k == rounds - 1:
            cells = stored(cells, "raked")
    return cells.select(*MARGINALS, "tokens", "weight")


def scale(cells: DataFrame, keep: float) -> float | None:
    """What the weight of a token is multiplied by; None if everything is taken. The heaviest cells are taken whole as far as needed."""
    order = Window.partitionBy(F.lit(0)).orderBy(F.col("each").desc(), *MARGINALS)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy(F.lit(0))
    whole = lambda c: F.coalesce(F.sum(c).over(before), F.lit(0.0))
    tried = cells.select("each", F.row_number().over(order).alias("k"), ((keep * F.sum("tokens").over(every) - whole("tokens")) / (1 - whole("weight"))).alias("scale"))
    found = tried.where(F.col("scale") * F.col("each") <= 1).agg(F.min_by("scale", "k").alias("scale")).first()
    return found["scale"]


def draw(seed: str) -> Column:
    """A number from 0 to 1 that depends on the doc_id alone."""
    digest = F.md5(F.concat(F.lit(f"{seed}-"), F.coalesce(F.col("doc_id").cast("string"), F.lit(NULL))).cast("binary"))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") / F.lit(float(16**13))


def weighed(documents: DataFrame, targets: dict[str, dict[str, float] | None], keep: float, seed: str) -> DataFrame:
    """Described documents with weight, probability and selected."""
    cells = rake(documents, targets).withColumn("each", F.col("weight") / F.col("tokens"))
    total = cells.agg(F.sum("tokens").alias("tokens")).first()["tokens"]
    if not total:
        return documents.select("*", F.lit(0.0).alias("weight"), F.lit(0.0).alias("probability"), F.lit(False).alias("selected"))
    factor = scale(cells, keep)
    probability = F.lit(1.0) if factor is None else F.least(F.lit(1.0), F.col("each") * factor)
    known = cells.select(*MARGINALS, (F.col("each") * float(total)).alias("weight"), probability.alias("probability"))
    out = documents.join(known, list(MARGINALS), "left")
    worded = F.col("n_tokens") > 0
    out = out.withColumns({c: F.when(worded, F.coalesce(c, F.lit(0.0))).otherwise(0.0) for c in ("weight", "probability")})
    return out.withColumn("selected", draw(seed) < F.col("probability"))


def mixed(docs: DataFrame, targets: dict[str, dict[str, float] | None], keep: float = KEEP, seed: str = "mix") -> DataFrame:
    """doc_id, the categories, n_tokens, weight of a token, probability and selected, for each row of documents."""
    return weighed(described(docs), targets, keep, seed).select("doc_id", *MARGINALS, "n_tokens", "weight", "probability", "selected")


def sample(docs: DataFrame, targets: dict[str, dict[str, float] | None], keep: float = KEEP, seed: str = "mix") -> DataFrame:
    """The selected rows with all their columns."""
    row = F.struct(*[docs[c] for c in docs.columns]).alias("row")
    return weighed(described(docs, row), targets, keep, seed).where("selected").select("row.*")


def oracle(targets: dict[str, dict[str, float] | None], keep: float = KEEP, seed: str = "mix", rounds: int = ROUNDS) -> str:
    """The same in DuckDB's SQL, rounded as the query is."""
    def target(m: str) -> str:
        share = f"(sum(tokens) OVER (PARTITION BY {m}))::DOUBLE / (sum(tokens) OVER ())"
        given = targets.get(m)
        if given is None:
            return f"pow({share}, {TEMPER})"
        return "CASE " + " ".join(f"WHEN {m} = '{c}' THEN {float(v)!r}::DOUBLE" for c, v in given.items()) + f" ELSE {share} END"

    steps, last = [], "scaled"
    for k in range(rounds):
        for m in MARGINALS:
            steps.append(f"r{k}_{m} AS MATERIALIZED (SELECT * REPLACE (weight * target_{m} / (sum(weight) OVER (PARTITION BY {m})) AS weight) FROM {last})")
            last = f"r{k}_{m}"
    scaled = ", ".join(f"target_{m} / (SELECT sum(t) FROM (SELECT DISTINCT {m}, target_{m} AS t FROM targets)) AS target_{m}" for m in MARGINALS)
    length = "greatest(length(text), 1)"
    return f"""
WITH described AS (
  SELECT doc_id, coalesce(source, '{NULL}') AS source, coalesce(lang, '{NULL}') AS lang,
    CASE WHEN text IS NULL THEN '{NULL}' WHEN (length(text) - length(replace(text, '|', ''))) / {length} > 0.02 THEN 'tables'
      WHEN (length(text) - length(translate(text, '#*$%&<>', ''))) / {length} > 0.05 THEN 'marked'
      WHEN contains(text, '@') OR contains(text, '://') THEN 'contacts' ELSE 'prose' END AS topic,
    coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS n_tokens
  FROM documents),
cells AS (SELECT source, lang, topic, sum(n_tokens)::DOUBLE AS tokens FROM described WHERE n_tokens > 0 GROUP BY ALL),
targets AS MATERIALIZED (SELECT *, {", ".join(f"{target(m)} AS target_{m}" for m in MARGINALS)} FROM cells),
scaled AS MATERIALIZED (SELECT source, lang, topic, tokens, tokens / (sum(tokens) OVER ()) AS weight, {scaled} FROM targets),
{", ".join(steps)},
each AS (SELECT *, weight / tokens AS e FROM {last}),
tried AS (SELECT e, row_number() OVER o AS k,
    ({keep!r} * (sum(tokens) OVER ()) - coalesce(sum(tokens) OVER b, 0)) / (1 - coalesce(sum(weight) OVER b, 0)) AS c FROM each
  WINDOW o AS (ORDER BY e DESC, source, lang, topic), b AS (ORDER BY e DESC, source, lang, topic ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
factor AS (SELECT min_by(c, k) AS c FROM tried WHERE c * e <= 1),
known AS (SELECT source, lang, topic, e * (SELECT sum(tokens) FROM each) AS weight, least(1.0, coalesce(e * (SELECT c FROM factor), 1.0)) AS probability FROM each)
SELECT d.doc_id, d.source, d.lang, d.topic, d.n_tokens, CASE WHEN n_tokens > 0 THEN round(coalesce(weight, 0), 6) ELSE 0 END AS weight,
  CASE WHEN n_tokens > 0 THEN round(coalesce(probability, 0), 6) ELSE 0 END AS probability,
  n_tokens > 0 AND ('0x' || substr(md5('{seed}-' || coalesce(d.doc_id::VARCHAR, '{NULL}')), 1, 13))::BIGINT / {float(16**13)!r} < coalesce(probability, 0) AS selected
FROM described d LEFT JOIN known k USING (source, lang, topic)
"""
