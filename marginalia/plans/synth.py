"""Deterministic notes, terms and span tables from the star-schema tables, by expressions that Spark and DuckDB share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.sections import with_sections

SYMPTOMS = ["đau ngực", "ho khan", "khó thở", "chóng mặt", "buồn nôn", "táo bón", "phù"]
DIAGNOSES = ["viêm phổi", "suy tim", "xơ gan", "tăng huyết áp", "đột quỵ"]
DRUGS = ["aspirin", "metoprolol", "amlodipine", "losartan", "metformin", "insulin"]
LABS = ["WBC", "CRP", "Glucose", "ALT", "Creatinine", "Kali"]


def _pick(words: list[str], key: str, duck: bool) -> str:
    """The word of a list at key modulo its length."""
    return "CASE " + " ".join(f"WHEN ({key}) % {len(words)} = {i} THEN '{w}'" for i, w in enumerate(words)) + " END"


def parts(duck: bool = False) -> dict[str, str]:
    """The pieces of a note as SQL over c_custkey (column k)."""
    s = lambda words, key: _pick(words, key, duck)
    text = "VARCHAR" if duck else "STRING"
    return {
        "s1": s(SYMPTOMS, "k"), "s2": s(SYMPTOMS, "k + 3"), "d1": s(DIAGNOSES, "k"), "d2": s(DIAGNOSES, "k + 2"), "m": s(DRUGS, "k"),
        "dose": f"CAST(5 * (1 + k % 20) AS {text})", "lab": s(LABS, "k"), "val": f"CAST(3 + k % 97 AS {text})",
        "tail": f"CASE k % 3 WHEN 0 THEN 'Gia đình: mẹ bị ' || {s(DIAGNOSES, 'k + 1')} || '.' WHEN 1 THEN 'Không ghi nhận ' || {s(SYMPTOMS, 'k + 5')} || '.' ELSE 'Đã tái khám' END",
    }


NOTE = "CASE WHEN k % 17 = 0 THEN 'Hẹn lịch.' ELSE 'Lý do nhập viện: ' || s1 || ', ' || s2 || nl || 'Tiền sử bệnh: ' || d1 || '.' || nl || 'Toa thuốc: ' || m || ' ' || dose || ' mg po bid' || nl || 'Kết quả xét nghiệm:' || nl || '- ' || lab || ': ' || val || ' mg/dL' || nl || 'Chẩn đoán: ' || d2 || nl || tail || nl END"


def notes_sql(duck: bool) -> str:
    p = ", ".join(f"{v} AS {n}" for n, v in parts(duck).items())
    nl, text = ("chr(10)", "VARCHAR") if duck else ("char(10)", "STRING")
    return f"SELECT CAST(k AS {text}) AS record_id, k, s1, s2, d1, d2, m, dose, lab, val, tail, {NOTE} AS raw_text FROM (SELECT k, {p}, {nl} AS nl FROM (SELECT c_custkey AS k FROM customer) AS a) AS b"


def notes(spark: SparkSession, sf_dir: str, sections: bool = True) -> DataFrame:
    """A note of every customer. Keys take little room in a file, so few tasks would read them and then make and work on
    all notes: the keys are dealt to every core first."""
    keys = spark.read.parquet(f"{sf_dir}/customer.parquet").select("c_custkey")
    keys.repartition(max(1, spark.sparkContext.defaultParallelism)).createOrReplaceTempView("customer")
    out = spark.sql(notes_sql(False)).select("record_id", "raw_text")
    return with_sections(out) if sections else out


TYPES = "CASE {} % 5 WHEN 0 THEN 'symptom' WHEN 1 THEN 'lab_test' WHEN 2 THEN 'lab_result' WHEN 3 THEN 'diagnosis' ELSE 'drug' END"


def numbered(duck: bool) -> str:
    """Line items with l_no, their number in the order."""
    return f"(SELECT *, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity) AS {'INTEGER' if duck else 'INT'}) AS l_no FROM lineitem) AS l"


def spans_sql(duck: bool) -> str:
    """Span rows of 'records' (orders) from their line items."""
    text, i = ("VARCHAR", "INTEGER") if duck else ("STRING", "INT")
    return f"SELECT CAST(l_orderkey AS {text}) AS record_id, CAST(l_no AS {i}) AS gen_ord, 't' || CAST(l_partkey % 50 AS {text}) AS text, CAST(l_partkey % 12 AS {i}) AS start, CAST(l_partkey % 12 + 1 + l_suppkey % 9 AS {i}) AS {'"end"' if duck else '`end`'}, {TYPES.format('l_suppkey')} AS concept_type, CAST(60 + l_partkey % 40 AS DOUBLE) / 100 AS confidence, CASE l_partkey % 4 WHEN 0 THEN 'model_exact' WHEN 1 THEN 'diagnosis_cue' WHEN 2 THEN 'med_regex' ELSE 'symptom_lexicon' END AS source FROM {numbered(duck)}"


def span_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    spark.read.parquet(f"{sf_dir}/lineitem.parquet").createOrReplaceTempView("lineitem")
    return spark.sql(spans_sql(False)).selectExpr("record_id", "gen_ord", "text", "start", "`end`", "concept_type", "'isPresent' AS assertion", "cast(null AS array<string>) AS assertions", "cast(array() AS array<struct<id:string,score:double,source:string>>) AS candidates", "confidence", "source")


def entities_sql(duck: bool, side: str) -> str:
    """Result entities of two sides that agree on most places."""
    text, i, end = ("VARCHAR", "INTEGER", '"end"') if duck else ("STRING", "INT", "`end`")
    arr = (lambda c, x: f"CASE WHEN {c} THEN [{x}] ELSE CAST([] AS VARCHAR[]) END") if duck else (lambda c, x: f"CASE WHEN {c} THEN array({x}) ELSE cast(array() AS array<string>) END")
    shift = "0" if side == "a" else "CASE WHEN l_partkey % 7 = 0 THEN 3 ELSE 0 END"
    keep = "true" if side == "a" else "l_partkey % 11 <> 0"
    kind = "CASE l_suppkey % 4 WHEN 0 THEN 'THUỐC' WHEN 1 THEN 'CHẨN_ĐOÁN' WHEN 2 THEN 'TRIỆU_CHỨNG' ELSE 'TÊN_XÉT_NGHIỆM' END"
    said = arr("l_partkey % 3 = 0" if side == "a" else "l_partkey % 6 = 0", "'isNegated'")
    cand = arr("l_suppkey % 4 < 2" if side == "a" else "l_suppkey % 4 < 2 AND l_partkey % 2 = 0", f"CAST({'l_partkey' if side == 'a' else 'l_partkey + 1'} AS {text})")
    return f"SELECT CAST(l_orderkey AS {text}) AS record_id, CAST(l_no AS {i}) AS ord, 'T' || CAST(l_partkey % 50 AS {text}) AS text, {kind} AS type, CAST(l_no * 20 AS {i}) AS start, CAST(l_no * 20 + 5 + l_suppkey % 9 + {shift} AS {i}) AS {end}, {said} AS assertions, {cand} AS candidates FROM {numbered(duck)} WHERE {keep}"


def entity_rows(spark: SparkSession, sf_dir: str, side: str) -> DataFrame:
    spark.read.parquet(f"{sf_dir}/lineitem.parquet").createOrReplaceTempView("lineitem")
    return spark.sql(entities_sql(False, side))
