"""The span row, and what is done to the spans of a note: validation, repair, dedup, overlap merge, output."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import lexicons as L
from ..functions import text as T

CANDIDATE = "struct<id:string,score:double,source:string>"
FIELDS = ["gen_ord", "text", "start", "end", "concept_type", "assertion", "assertions", "candidates", "confidence", "source"]
SCHEMA = f"record_id string, gen_ord int, text string, start int, end int, concept_type string, assertion string, assertions array<string>, candidates array<{CANDIDATE}>, confidence double, source string"
_LINE = f"struct<a:int,b:int,c:double,f:int,gen_ord:int,text:string,start:int,end:int,concept_type:string,assertion:string,assertions:array<string>,candidates:array<{CANDIDATE}>,confidence:double,source:string>"


def spans(rows: DataFrame, kind, confidence, source: str, least: int = 1, assertion: Column | None = None, assertions: Column | None = None, candidates: Column | None = None, text: Column | None = None) -> DataFrame:
    """Span rows of rows with record_id, raw_text, gen_ord, start and end; texts shorter than `least` go."""
    lit = lambda x: x if isinstance(x, Column) else F.lit(x)
    out = rows.select(
        F.col("record_id").cast("string").alias("record_id"), F.col("gen_ord").cast("int").alias("gen_ord"), (T.cut(F.col("raw_text"), F.col("start"), F.col("end")) if text is None else text).alias("text"), F.col("start").cast("int").alias("start"), F.col("end").cast("int").alias("end"),
        lit(kind).alias("concept_type"), (F.lit("isPresent") if assertion is None else assertion).alias("assertion"), (F.lit(None) if assertions is None else assertions).cast("array<string>").alias("assertions"), (F.array() if candidates is None else candidates).cast(f"array<{CANDIDATE}>").alias("candidates"), lit(confidence).cast("double").alias("confidence"), F.lit(source).alias("source"),
    )
    return out.where(F.length("text") >= least)


def valid(spans_: DataFrame, notes: DataFrame) -> DataFrame:
    """Spans whose text stands at their offsets."""
    j = spans_.join(notes.select("record_id", "raw_text"), "record_id")
    ok = (F.col("start") >= 0) & (F.col("start") < F.col("end")) & (F.col("end") <= F.length("raw_text")) & (T.cut(F.col("raw_text"), F.col("start"), F.col("end")) == F.col("text"))
    return j.where(ok).select(*spans_.columns)


def repaired(spans_: DataFrame, notes: DataFrame, margin: int = 20) -> DataFrame:
    """A span whose text stands exactly once within margin characters moves there; other invalid ones go."""
    j = spans_.join(notes.select("record_id", "raw_text"), "record_id")
    here = (F.col("start") >= 0) & (F.col("start") < F.col("end")) & (F.col("end") <= F.length("raw_text")) & (T.cut(F.col("raw_text"), F.col("start"), F.col("end")) == F.col("text"))
    j = j.withColumn("_left", F.greatest(F.col("start") - margin, F.lit(0)))
    j = j.withColumn("_w", T.cut(F.col("raw_text"), F.col("_left"), F.least(F.length("raw_text"), F.col("end") + margin))).withColumn("_ok", here)
    j = j.withColumn("_at", F.expr("instr(_w, text)")).withColumn("_again", F.expr("instr(substring(_w, _at + 1), text)"))
    j = j.where("_ok OR (_at > 0 AND _again = 0 AND length(text) > 0)")
    start = F.when(F.col("_ok"), F.col("start")).otherwise(F.col("_left") + F.col("_at") - 1).cast("int")
    return j.withColumns({"start": start, "end": (start + F.length("text")).cast("int")}).select(*spans_.columns)


def overlap_ratio(a0, a1, b0, b1) -> Column:
    """E5: intersection over hull."""
    inter = F.greatest(F.lit(0), F.least(a1, b1) - F.greatest(a0, b0))
    hull = F.greatest(a1, b1) - F.least(a0, b0)
    return F.when(hull == 0, F.lit(0.0)).otherwise(inter.cast("double") / hull)


def deduped(spans_: DataFrame) -> DataFrame:
    """Of one (start, end, type) the most confident, the first of equal ones; `first_ord` is the place in line of
    the first."""
    key = Window.partitionBy("record_id", "start", "end", "concept_type")
    ranked = spans_.withColumn("_n", F.row_number().over(key.orderBy(F.col("confidence").desc(), "gen_ord"))).withColumn("first_ord", F.min("gen_ord").over(key))
    return ranked.where("_n = 1").drop("_n")


#: True where the new span x takes the slot of the old span o.
NEW_WINS = "CASE WHEN x.concept_type = o.concept_type AND abs(x.confidence - o.confidence) <= 0.08D THEN x.end - x.start >= o.end - o.start WHEN x.concept_type = 'drug' AND x.text RLIKE '(?U)\\\\d' THEN true WHEN o.concept_type = 'drug' AND o.text RLIKE '(?U)\\\\d' THEN false ELSE x.confidence >= o.confidence END"
_RATIO = "(CASE WHEN greatest(x.end, o.end) = least(x.start, o.start) THEN 0D ELSE greatest(0, least(x.end, o.end) - greatest(x.start, o.start)) / cast(greatest(x.end, o.end) - least(x.start, o.start) AS double) END)"


def confident(spans_: DataFrame, min_confidence: float = 0.65) -> DataFrame:
    """E2."""
    return spans_.where(F.col("confidence") >= F.lit(min_confidence))


def merged(spans_: DataFrame, min_confidence: float = 0.65) -> DataFrame:
    """Confident spans in order of (start, end, confidence descending) fold into slots; a span meets the
    first slot that it overlaps by more than half, and E6 decides who holds the slot. The fold is one aggregate() over
    the sorted spans of a note; spans must be valid (E1)."""
    line = deduped(confident(spans_, min_confidence))
    entry = F.struct(F.col("start").alias("a"), F.col("end").alias("b"), (-F.col("confidence")).alias("c"), F.col("first_ord").alias("f"), *FIELDS)
    per_note = line.groupBy("record_id").agg(F.array_sort(F.collect_list(entry)).alias("l"))
    fold = f"aggregate(l, cast(array() AS array<{_LINE}>), (acc, x) -> CASE WHEN exists(acc, o -> {_RATIO} > 0.5D) THEN transform(acc, (o, i) -> CASE WHEN i = array_position(transform(acc, o -> {_RATIO} > 0.5D), true) - 1 AND ({NEW_WINS}) THEN x ELSE o END) ELSE concat(acc, array(x)) END)"
    slots = per_note.select("record_id", F.expr(fold).alias("m"))
    # the final order is (start, end), equal ones by slot
    out = slots.select("record_id", F.expr("array_sort(transform(m, (x, i) -> named_struct('a', x.start, 'b', x.end, 'i', i, 'x', x)))").alias("m"))
    return out.select("record_id", F.posexplode("m").alias("_i", "_m")).select("record_id", F.col("_i").alias("gen_ord"), *[F.col(f"_m.x.{c}").alias(c) for c in FIELDS[1:]])


def boundary_consensus(spans_: DataFrame) -> DataFrame:
    """Token-model spans never stay; where a confident one, confirmed by a rule within two characters, shrinks a
    remembered symptom or test by 8 or more, or widens a test by 3 or more, it lends its boundary. Interval joins
    within a note."""
    ner = F.col("source").endswith("_ner")
    model = spans_.where(ner & (F.col("confidence") >= 0.90) & ~F.lower(F.trim("text")).isin("thuốc", "triệu chứng", "bệnh", "xét nghiệm", "kết quả") & (F.length(F.trim("text")) >= 3))
    rule = spans_.where(~ner & (F.col("source") != "model_exact")).select("record_id", "concept_type", F.col("start").alias("r0"), F.col("end").alias("r1"))
    sure = model.join(rule, ["record_id", "concept_type"]).where("abs(r0 - start) <= 2 AND abs(r1 - end) <= 2").select("record_id", "concept_type", F.col("start").alias("m0"), F.col("end").alias("m1"), F.col("text").alias("m_text"), F.col("confidence").alias("m_conf"), F.col("gen_ord").alias("m_ord")).distinct()
    rest = spans_.where(~ner)
    old = rest.where("source = 'model_exact' AND concept_type IN ('symptom', 'lab_test')").select("record_id", "gen_ord", "concept_type", "start", "end")
    fit = old.join(sure, ["record_id", "concept_type"]).where("(start <= m0 AND m1 <= end AND (end - start) - (m1 - m0) >= 8) OR (concept_type = 'lab_test' AND m0 <= start AND end <= m1 AND (m1 - m0) - (end - start) >= 3)")
    best = fit.groupBy("record_id", "gen_ord").agg(F.max_by(F.struct("m0", "m1", "m_text"), F.struct(F.expr("m1 - m0"), "m_conf", -F.col("m_ord"))).alias("m"))
    j = rest.join(best, ["record_id", "gen_ord"], "left")
    return j.withColumns({"start": F.coalesce("m.m0", "start"), "end": F.coalesce("m.m1", "end"), "text": F.coalesce("m.m_text", "text")}).select(*spans_.columns)


def resolved(spans_: DataFrame, notes: DataFrame, min_confidence: float = 0.65, token_models: bool = False) -> DataFrame:
    """E3 (where token models take part; the spans are then read five times, so they are kept), E1, E2, E4-E7 and then
    E8, the same merge once more; E9 changes nothing."""
    spans_ = boundary_consensus(spans_.persist()) if token_models else spans_
    return merged(merged(valid(spans_, notes), min_confidence), min_confidence)


def _any(conditions) -> Column:
    return reduce(Column.__or__, conditions)


def with_value(spans_: DataFrame) -> DataFrame:
    """Without spans that carry nothing; most rules spare remembered spans. Used before and after linking."""
    rows = spans_.withColumn("_k", T.filter_key(F.col("text")))
    key, kind = F.col("_k"), F.col("concept_type")
    starts = lambda words: _any([key.startswith(w) for w in words])
    symptom = (kind == "symptom") & (key.isin(L.DROP_SYMPTOM) | starts(L.DROP_SYMPTOM_PREFIX) | (key.contains("khoa cấp cứu") & key.contains("nhập viện")))
    scope = (kind == "lab_test") & key.startswith("nội soi (") & _any([key.contains(w) for w in ("cách đây", "cho thấy", "phát hiện")])
    bare = (F.size("candidates") == 0) & ((F.col("source") == "diagnosis_cue") | (F.length("text") > 45) | starts(L.DROP_DIAGNOSIS_PREFIX))
    diagnosis = (kind == "diagnosis") & (key.isin(L.DROP_DIAGNOSIS) | (F.col("text").contains(":") & starts(L.DROP_DIAGNOSIS_COLON_PREFIX)) | bare)
    lab = (kind == "lab_test") & ((F.length(F.trim("text")) == 1) | key.isin(L.DROP_LAB) | starts(L.DROP_LAB_PREFIX))
    place = (kind == "symptom") & starts(L.NON_SYMPTOM_PREFIX) & _any([key.contains(w) for w in L.NON_SYMPTOM_WORDS])
    return rows.where(~(symptom | scope | ((F.col("source") != "model_exact") & (diagnosis | lab | place)))).drop("_k")


def entities(spans_: DataFrame) -> DataFrame:
    """Output entities, one row each, with the sort key of B1 in `ord`."""
    label = F.create_map(*[F.lit(x) for kv in L.TYPE_LABELS.items() for x in kv])
    known = F.array(*[F.lit(x) for x in L.OUTPUT_ASSERTIONS])
    said = F.when(F.col("assertions").isNotNull(), F.filter("assertions", lambda a: F.array_contains(known, a))).when(F.array_contains(known, F.col("assertion")), F.array("assertion")).otherwise(F.array().cast("array<string>"))
    ids = F.transform("candidates", lambda c: F.regexp_replace(c["id"], "^(?:Rx|ICD10:)", ""))
    return spans_.select("record_id", F.struct("start", "end", "concept_type", "gen_ord").alias("ord"), "text", F.array("start", "end").alias("position"), F.coalesce(label[F.col("concept_type")], F.col("concept_type")).alias("type"), said.alias("assertions"), F.when(F.col("concept_type").isin("diagnosis", "drug"), ids).otherwise(F.array().cast("array<string>")).alias("candidates"))


def documents(entities_: DataFrame, notes: DataFrame) -> DataFrame:
    """B1: (record_id, entities): sorted entities of every note, an empty array for notes without any."""
    e = F.struct("ord", F.struct("text", "position", "type", "assertions", "candidates").alias("e"))
    per = entities_.groupBy("record_id").agg(F.transform(F.array_sort(F.collect_list(e)), lambda x: x["e"]).alias("entities"))
    empty = F.array().cast("array<struct<text:string,position:array<int>,type:string,assertions:array<string>,candidates:array<string>>>")
    return notes.select("record_id").join(per, "record_id", "left").select("record_id", F.coalesce("entities", empty).alias("entities"))


def uncovered(new: DataFrame, old: DataFrame) -> DataFrame:
    """Rows of `new` (record_id, type, start, end) that no entity of `old` of that type holds: an interval
    anti-join."""
    o = old.select("record_id", "type", F.col("start").alias("o0"), F.col("end").alias("o1"))
    return new.join(o, (new["record_id"] == o["record_id"]) & (new["type"] == o["type"]) & (F.col("o0") <= F.col("start")) & (F.col("end") <= F.col("o1")), "left_anti")


def spread(rows: DataFrame, *by: str) -> DataFrame:
    """Rows dealt to all cores, by columns if named. Without it, few bytes go to few tasks, however much work they are."""
    return rows.repartition(max(4, 2 * rows.sparkSession.sparkContext.defaultParallelism), *by)
