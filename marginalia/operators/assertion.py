"""Assertions of spans: cue rules, trained classifiers, scope repair."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import lexicons as L
from ..functions import text as T
from . import sections as S
from .spans import spread


def has_cue(text: Column, cues: list[str]) -> Column:
    """G1, on a normal form."""
    return text.rlike(T.whole_word(cues).replace("(?iuU)", "(?U)"))


def in_context(spans_: DataFrame, notes: DataFrame) -> DataFrame:
    """Spans with section, left context (70 characters of it), sentence, left clause and clause, in normal form."""
    j = spans_.join(notes.select("record_id", "raw_text", "sections"), "record_id")
    raw, a, b = F.col("raw_text"), F.col("start"), F.col("end")
    left, sentence = S.sentence_window(raw, a, b)
    clause_left, clause = S.clause_window(raw, a, b)
    tail = lambda c: F.when(F.length(c) > 70, F.substring(c, -70, 70)).otherwise(c)
    out = j.withColumns({"section": S.section_of(F.col("sections"), a, b), "_left": left, "sentence": T.norm(sentence), "_cl": clause_left, "clause": T.norm(clause)})
    out = out.withColumns({"left": T.norm(tail(F.col("_left"))), "clause_left": T.norm(tail(F.col("_cl")))})
    return out.select(*spans_.columns, "section", "left", "sentence", "clause_left", "clause")


def rule() -> Column:
    """G2 on the columns of in_context()."""
    within = lambda c, cues: c.rlike("|".join(T.alternatives([x]) for x in cues))
    return (
        F.when((F.col("section") == "family_history") | has_cue(F.col("sentence"), L.FAMILY), "isFamily")
        .when(within(F.col("left"), L.NEGATION), "isNegated")
        .when(within(F.col("sentence"), L.SPECULATION), "isPossible")
        .when(F.col("section").isin("past_history", "medication_history") | within(F.col("sentence"), L.HISTORICAL), "isHistorical")
        .otherwise("isPresent")
    )


def repaired(rows: DataFrame, negated: bool = False, family: bool = True, historical: bool = False) -> DataFrame:
    """G5 on the columns of in_context(): each label stays unless its repair is on and its scope shows no cue."""
    now = F.when(F.size("assertions") > 0, F.col("assertions")).when(F.length("assertion") > 0, F.array("assertion")).otherwise(F.array().cast("array<string>"))
    keep = [
        ("isNegated", F.lit(not negated) | has_cue(F.col("clause_left"), L.NEGATION)),
        ("isFamily", F.lit(not family) | (F.col("section") == "family_history") | has_cue(F.col("clause"), L.FAMILY)),
        ("isHistorical", F.lit(not historical) | F.col("section").isin("past_history", "medication_history") | has_cue(F.col("clause"), L.HISTORICAL)),
    ]
    fit = F.array_compact(F.array(*[F.when(F.array_contains(now, label) & cond, F.lit(label)) for label, cond in keep]))
    fit = F.when(F.col("concept_type").isin("diagnosis", "drug", "symptom"), fit).otherwise(F.array().cast("array<string>"))
    return rows.withColumn("assertions", fit).withColumn("assertion", F.coalesce(F.get("assertions", F.lit(0)), F.lit("isPresent")))


def asserted(spans_: DataFrame, notes: DataFrame, scope_repair: bool = True, classified: DataFrame | None = None, **repair) -> DataFrame:
    """G3, G4 and G2, then G5: spans of models that carry assertions keep them; a classifier's non-empty answer
    (record_id, gen_ord, labels) goes before the rules."""
    rows = in_context(spans_, notes)
    sure = (F.col("source").startswith("model") | F.col("source").startswith("llm_")) & (F.size("assertions") > 0)
    if classified is not None:
        rows = rows.join(classified.select("record_id", "gen_ord", F.col("labels").alias("_l")), ["record_id", "gen_ord"], "left")
    else:
        rows = rows.withColumn("_l", F.lit(None).cast("array<string>"))
    told = ~sure & (F.size("_l") > 0)
    rows = rows.withColumn("assertion", F.when(sure, F.col("assertion")).when(told, F.col("_l")[0]).otherwise(rule())).withColumn("assertions", F.when(told, F.col("_l")).otherwise(F.col("assertions")))
    return (repaired(rows, **repair) if scope_repair else rows).select(*spans_.columns)


def train_classifiers(examples: DataFrame, labels: list[str] = L.OUTPUT_ASSERTIONS, features: int = 1 << 16) -> dict:
    """For each label with both answers among examples (text, assertions, and `copies` where a row stands for many),
    words, pairs and triples with inverse document frequencies and a class-weighted logistic regression. Equal examples
    are one row that weighs as much. label -> PipelineModel."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import ElementwiseProduct, HashingTF, NGram, RegexTokenizer, VectorAssembler
    from pyspark.ml.linalg import Vectors
    from pyspark.ml.stat import Summarizer

    copies = F.sum("copies") if "copies" in examples.columns else F.count("*")
    rows = spread(examples, "text").groupBy("text", "assertions").agg(copies.cast("double").alias("copies")).persist()
    words, cols = [RegexTokenizer(inputCol="text", outputCol="w", pattern=r"(?U)\W+", minTokenLength=2)], []
    for k in (1, 2, 3):
        src = "w" if k == 1 else f"g{k}"
        words += [NGram(n=k, inputCol="w", outputCol=src)] if k > 1 else []
        words += [HashingTF(inputCol=src, outputCol=f"t{k}", numFeatures=features)]
        cols.append(f"i{k}")
    out, scaled = {}, None
    for label in labels:
        told = rows.withColumn("label", F.array_contains("assertions", label).cast("double"))
        n = {r[0]: r[1] for r in told.groupBy("label").agg(F.sum("copies")).collect()}
        if len(n) < 2:
            continue
        total = sum(n.values())
        if scaled is None:
            # the estimator for these frequencies counts rows, not what they weigh
            seen = rows.select("text", "copies")
            for stage in words:
                seen = (stage.copy({stage.binary: True}) if isinstance(stage, HashingTF) else stage).transform(seen)
            df = seen.select(*[Summarizer.metrics("sum").summary(F.col(f"t{k}"), F.col("copies"))["sum"].alias(f"t{k}") for k in (1, 2, 3)]).first()
            scaled = [ElementwiseProduct(scalingVec=Vectors.dense(np.log((total + 1) / (np.rint(df[f"t{k}"].toArray()) + 1))), inputCol=f"t{k}", outputCol=f"i{k}") for k in (1, 2, 3)]
        told = told.withColumn("weight", F.col("copies") * F.when(F.col("label") == 1, total / (2 * n[1.0])).otherwise(total / (2 * n[0.0])))
        stages = [*words, *scaled, VectorAssembler(inputCols=cols, outputCol="features"), LogisticRegression(weightCol="weight", maxIter=100, regParam=1e-3)]
        out[label] = Pipeline(stages=stages).fit(told)
    rows.unpersist()
    return out


def classify(spans_: DataFrame, notes: DataFrame, models: dict) -> DataFrame:
    """(record_id, gen_ord, labels) of the labels whose model says yes to the marked context."""
    j = spans_.join(notes.select("record_id", "raw_text"), "record_id").select("record_id", "gen_ord", S.marked_context(F.col("raw_text"), F.col("start"), F.col("end")).alias("text"))
    for label, model in models.items():
        j = model.transform(j).select(*j.columns, F.when(F.col("prediction") == 1, F.lit(label)).alias(f"_{label}"))
    return j.select("record_id", "gen_ord", F.array_compact(F.array(*[F.col(f"_{x}") for x in models] or [F.lit(None).cast("string")])).alias("labels"))
