"""Span generators: DataFrames of notes in, DataFrames of span rows out.

The regular expressions run in the JVM and the offsets come from marked matches, exploded on the note row. Matching of
large alias tables is a join of the note's word n-grams."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import lexicons as L
from ..functions import text as T
from . import sections as S
from .spans import spans

_I = "(?iuUd)"
_MILLION = 1_000_000
_SMALL_LEXICON = 50_000


def _one(pattern: str, before: str = "") -> tuple[str, str]:
    """A pattern and the replacement that marks its part behind `before`."""
    return f"(?<pre>{before})(?<mid>{pattern})", f"${{pre}}{T.OPEN}${{mid}}{T.CLOSE}"


def found(notes: DataFrame, pattern: str, marked: str = "$0", gen: int = 0) -> DataFrame:
    """One row for each match: the note's columns, start, end, gen_ord and the matched text as `hit`."""
    rows = notes.where("raw_text IS NOT NULL").select("*", F.posexplode(T.hits(F.col("raw_text"), pattern, marked)).alias("_i", "_h"))
    rows = rows.select(*notes.columns, (F.col("_i") * 2 + gen * _MILLION).alias("gen_ord"), F.col("_h.start").alias("start"), F.col("_h.end").alias("end"))
    return rows.withColumn("hit", T.cut(F.col("raw_text"), F.col("start"), F.col("end")))


def _trim(rows: DataFrame) -> DataFrame:
    """C11 on the columns start and end."""
    a, b = T.trim_span(F.col("raw_text"), F.col("start"), F.col("end"))
    return rows.withColumns({"start": a, "end": b})


def _shrink(rows: DataFrame, chars: str) -> DataFrame:
    """start and end moved over the characters of a class."""
    body = T.cut(F.col("raw_text"), F.col("start"), F.col("end"))
    lead, tail = F.length(F.regexp_extract(body, f"^(?:{chars})*", 0)), F.length(F.regexp_extract(body, rf"(?:{chars})*\z", 0))
    return rows.withColumns({"start": F.col("start") + lead, "end": F.greatest(F.col("start") + lead, F.col("end") - tail)})


def union(*parts: DataFrame) -> DataFrame:
    """D29."""
    return reduce(DataFrame.unionByName, parts)


# lexicons


def usable_alias(alias: Column) -> Column:
    """D4."""
    a = F.trim(alias)
    low = F.lower(a)
    short = low.rlike("^(?:bệnh|các|những) ") & (F.size(F.split(T.squeeze(low), " ")) <= 3)
    head = low.isin(L.SYMPTOM_HEADS)
    for h in L.SYMPTOM_HEADS:
        head = head | low.startswith(h + " ")
    return F.length(a).between(4, 90) & ~low.isin(L.GENERIC_ALIASES) & ~short & ~head & a.rlike("[À-ỹđĐ]") & ~a.rlike(r"(?U)\d{2,}|[/\\{}\[\]]")


def longest_aliases(aliases: DataFrame, column: str = "alias", limit: int = 30_000) -> DataFrame:
    """A top-k by (length, text) descending; Spark plans TakeOrderedAndProject."""
    return aliases.select(column).distinct().orderBy(F.length(column).desc(), F.col(column).desc()).limit(limit)


def bounded_drug_aliases(aliases: DataFrame, column: str = "alias", most: int = 5000) -> DataFrame:
    """Of more than `most` aliases only single words of up to 48 characters, besides the built-in names."""
    every = aliases.select(F.col(column).alias("alias")).distinct()
    many = every.count() > most
    kept = every.where((F.length("alias") <= 48) & ~F.col("alias").contains(" ")) if many else every
    return kept.union(every.sparkSession.createDataFrame([(x,) for x in L.DRUGS], "alias string")).distinct()


def lexicon(notes: DataFrame, terms: list[str], gen: int = 0) -> DataFrame:
    """Whole-word, case-blind, longest alternative first, leftmost non-overlapping."""
    return found(notes, T.whole_word([t.strip() for t in terms if t and len(t.strip()) >= 2]), gen=gen)


def lexicon_join(notes: DataFrame, aliases: DataFrame, column: str = "alias") -> DataFrame:
    """D1 for tables too large for an alternation: word n-grams of every note join the lower-cased aliases on equality
    (the aliases are broadcast up to _SMALL_LEXICON of them), then leftmost-longest hits are kept by a fold in each note.
    An n-gram is put together from its words and the gaps between, so no row carries the text of its note.
    (record_id, start, end, alias)."""
    words = aliases.select(F.trim(F.col(column)).alias("alias")).where(F.length("alias") >= 2).select(F.lower("alias").alias("key"), "alias").groupBy("key").agg(F.min("alias").alias("alias"))
    words = words.withColumn("n", F.size(F.regexp_extract_all("key", F.lit(r"(?U)\w+|[^\w\s]+"), 0)))
    most, many = words.agg(F.max("n"), F.count("*")).first()
    words = F.broadcast(words) if many <= _SMALL_LEXICON else words.hint("merge")
    tok = notes.where("raw_text IS NOT NULL").select("record_id", T.pieces(F.col("raw_text"), r"(?U)\w+|[^\w\s]+").alias("p")).where("size(p) > 1")
    tok = tok.select("record_id", "p", T.offsets(F.col("p")).alias("at"))
    gram = "named_struct('start', at[2 * i + 1], 'end', at[2 * (i + m)], 'key', lower(array_join(slice(p, 2 * i + 2, 2 * m - 1), '')))"
    grams = tok.select("record_id", F.explode(F.expr(f"flatten(transform(sequence(0, size(p) div 2 - 1), i -> transform(sequence(1, least({max(1, most or 0)}, size(p) div 2 - i)), m -> {gram})))")).alias("g"))
    grams = grams.select("record_id", "g.start", "g.end", "g.key")
    found = grams.join(words, "key").groupBy("record_id").agg(F.array_sort(F.collect_list(F.struct(F.col("start"), (-F.col("end")).alias("neg"), F.col("alias")))).alias("h"))
    left = F.expr("aggregate(h, cast(array() AS array<struct<start:int,end:int,alias:string>>), (acc, x) -> CASE WHEN size(acc) = 0 OR x.start >= element_at(acc, -1).end THEN concat(acc, array(named_struct('start', x.start, 'end', -x.neg, 'alias', x.alias))) ELSE acc END)")
    return found.select("record_id", F.explode(left).alias("x")).select("record_id", "x.*")


def symptom_lexicon(notes: DataFrame, gen: int = 40) -> DataFrame:
    """D2."""
    rows = _trim(lexicon(notes, L.SYMPTOMS, gen)).withColumn("section", S.section_of(F.col("sections"), F.col("start"), F.col("end")))
    conf = F.when(F.col("section").isin("current_illness", "admission_reason"), 0.84).otherwise(0.68)
    return spans(rows.where("section <> 'medication_history'"), "symptom", conf, "symptom_lexicon")


def diagnosis_lexicon(notes: DataFrame, extra: list[str] | None = None, aliases: DataFrame | None = None, gen: int = 30) -> DataFrame:
    """D3: the built-in terms with `extra` ones, or a table of aliases by the n-gram join."""
    if aliases is None:
        rows = lexicon(notes, L.DIAGNOSES + (extra or []), gen)
    else:
        every = aliases.select("alias").union(notes.sparkSession.createDataFrame([(x,) for x in L.DIAGNOSES], "alias string"))
        hit = lexicon_join(notes, every).drop("alias")
        rows = notes.join(hit, "record_id").withColumn("gen_ord", F.col("start") + gen * _MILLION).withColumn("hit", T.cut(F.col("raw_text"), F.col("start"), F.col("end")))
    rows = _trim(rows).withColumn("section", S.section_of(F.col("sections"), F.col("start"), F.col("end")))
    return spans(rows, "diagnosis", F.when(F.col("section") == "diagnosis", 0.88).when(F.col("section") == "past_history", 0.82).otherwise(0.76), "diagnosis_lexicon")


# Phrases behind cues


def phrase_parts(phrases: DataFrame) -> DataFrame:
    """The parts of each row's span between commas, semicolons, conjunctions and dashes, trimmed, of 3 to 90
    characters."""
    gaps = F.filter(T.hits(F.col("hit"), _I + L.PHRASE_SPLIT), lambda g: g["end"] > g["start"])
    rows = phrases.withColumn("_g", gaps)
    parts = F.zip_with(F.concat(F.array(F.lit(0)), F.col("_g.end")), F.concat(F.col("_g.start"), F.array(F.length("hit"))), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    rows = rows.select(*[c for c in phrases.columns if c not in ("start", "end", "gen_ord")], F.col("start").alias("_s"), F.col("gen_ord").alias("_o"), F.posexplode(parts).alias("_i", "_p"))
    rows = rows.select("*", (F.col("_s") + F.col("_p.a")).alias("start"), (F.col("_s") + F.col("_p.b")).alias("end"), (F.col("_o") + F.col("_i")).alias("gen_ord"))
    rows = _shrink(rows, r"[ :\-()\[\]]").drop("hit")
    return rows.withColumn("hit", T.cut(F.col("raw_text"), F.col("start"), F.col("end"))).where((F.col("end") - F.col("start")).between(3, 90)).select(*phrases.columns)


def cued_diagnoses(notes: DataFrame, gen: int = 50) -> DataFrame:
    """D6."""
    heads = F.array(*[F.lit(h) for h in L.SYMPTOM_HEADS])
    out = []
    for k, (cue, most, conf) in enumerate(((L.DIAGNOSIS_CUE, 140, 0.80), (L.HISTORY_CUE, 120, 0.74))):
        pat, rep = _one(rf"[^.;\n]{{3,{most}}}", cue)
        rows = phrase_parts(found(notes, _I + pat, rep, gen + k)).withColumn("low", F.lower("hit"))
        rows = rows.where((F.length(F.trim("hit")) >= 4) & ~F.exists(heads, lambda h: F.col("low").contains(h)))
        out.append(spans(_shrink(_trim(rows), "[ :\\-]"), "diagnosis", conf, "diagnosis_cue", 2))
    return union(*out)


def cued_symptoms(notes: DataFrame, gen: int = 60) -> DataFrame:
    """D7."""
    heads = F.array(*[F.lit(h) for h in L.SYMPTOM_HEADS])
    pat, rep = _one(r"[^.;\n]{3,160}", L.COMPLAINT_CUE)
    rows = phrase_parts(found(notes, _I + pat, rep, gen)).withColumn("low", F.lower("hit")).where(F.exists(heads, lambda h: F.col("low").startswith(h)))
    return spans(_shrink(_trim(rows), "[ :\\-]"), "symptom", 0.72, "symptom_cue", 2)


# drugs


def _known(aliases: list[str]) -> Column:
    return F.lower("hit").rlike("(?u)^(?:" + T.alternatives([a.lower() for a in aliases]) + ")")


def dosed_drugs(notes: DataFrame, aliases: list[str] = L.DRUGS, gen: int = 10) -> DataFrame:
    """D9."""
    pat = rf"{_I}(?<![A-Za-z0-9])(?:{L.DRUG_WORD}(?:\s+{L.DRUG_WORD}){{0,3}}\s+{L.DRUG_STRENGTH}(?:\s+{L.DRUG_ROUTE})?(?:\s+{L.DRUG_FREQUENCY})?)"
    return spans(_trim(found(notes, pat, gen=gen).where(_known(aliases))), "drug", 0.92, "med_regex", 2)


def drug_aliases(notes: DataFrame, aliases: list[str] = L.DRUGS, gen: int = 11) -> DataFrame:
    """D10."""
    rows = found(notes, rf"(?iu)(?<![A-Za-z0-9])(?:{T.alternatives(aliases)})(?![A-Za-z0-9])", gen=gen)
    tail = F.substring(F.col("raw_text"), F.col("end") + 1, F.lit(70))
    rows = rows.withColumn("dose", F.length(F.regexp_extract(tail, rf"{_I}^\s+{L.DRUG_STRENGTH}(?:\s+{L.DRUG_ROUTE})?(?:\s+{L.DRUG_FREQUENCY})?", 0)))
    left = F.lower(T.cut(F.col("raw_text"), F.greatest(F.col("start") - 80, F.lit(0)), F.col("start")))
    rows = rows.where((F.col("dose") > 0) | F.lower("hit").isin(L.DRUGS) | left.rlike(r"(?U)(?:thuốc|toa|dùng|sử dụng|điều trị)\W*\z"))
    return spans(_trim(rows.withColumn("end", F.col("end") + F.col("dose"))), "drug", F.when(F.col("dose") > 0, 0.92).otherwise(0.88), "med_alias", 2)


def cued_drugs(notes: DataFrame, aliases: list[str] = L.DRUGS, gen: int = 12) -> DataFrame:
    """D11."""
    pat, rep = _one(rf"{L.DRUG_WORD}(?:\s+{L.DRUG_WORD}){{0,3}}(?:\s+{L.DRUG_STRENGTH})?", L.DRUG_CUE)
    return spans(_trim(found(notes, _I + pat, rep, gen).where(_known(aliases) | F.col("hit").rlike(_I + L.DRUG_STRENGTH))), "drug", 0.70, "med_cue", 2)


# laboratory

_WORD = "A-Za-zÀ-ỹĐđ0-9"
_KNOWN_LAB = rf"(?:{T.alternatives(L.LABS)})(?:\s*\([^:\n;]{{1,90}}\))?"


def _pairs(notes: DataFrame, pattern: str, gen: int) -> DataFrame:
    """Matches of a pattern with groups n, m and v: the name as the span, the value as v_start and v_end. The value's
    marks are found by walking the same matches again."""
    names = T.hits(F.col("raw_text"), pattern, f"{T.OPEN}${{n}}{T.CLOSE}${{m}}${{v}}")
    values = T.hits(F.col("raw_text"), pattern, f"${{n}}${{m}}{T.OPEN}${{v}}{T.CLOSE}")
    rows = notes.where("raw_text IS NOT NULL").select(*notes.columns, F.posexplode(F.arrays_zip(names.alias("n"), values.alias("v"))).alias("_i", "_p"))
    rows = rows.select(*notes.columns, (F.col("_i") * 2 + gen * _MILLION).alias("gen_ord"), F.col("_p.n.start").alias("start"), F.col("_p.n.end").alias("end"), F.col("_p.v.start").alias("v_start"), F.col("_p.v.end").alias("v_end"))
    return rows.withColumn("hit", T.cut(F.col("raw_text"), F.col("start"), F.col("end")))


def _both(rows: DataFrame, test_conf: float, test_source: str, value_conf: float, value_source: str) -> DataFrame:
    value = rows.withColumns({"start": F.col("v_start"), "end": F.col("v_end"), "gen_ord": F.col("gen_ord") + 1})
    return spans(_shrink(rows, r"(?U:\s)"), "lab_test", test_conf, test_source).unionByName(spans(_trim(value), "lab_result", value_conf, value_source))


def lab_pairs(notes: DataFrame, gen: int = 70) -> DataFrame:
    """D13."""
    rows = _pairs(notes, rf"{_I}(?<![{_WORD}])(?<n>{_KNOWN_LAB})(?<m>\s*[:：]\s*)(?<v>{L.LAB_VALUE})", gen)
    return _both(rows.where(F.length(T.squeeze(F.col("hit"))) <= 120), 0.86, "lab_name_value", 0.84, "lab_value")


def generic_lab_pairs(notes: DataFrame, gen: int = 71) -> DataFrame:
    """D14."""
    rows = _pairs(notes, rf"(?Ud)(?<![{_WORD}])(?<n>{L.GENERIC_LAB_NAME})(?<m>\s*[:：]\s*)(?<v>{L.LAB_VALUE})", gen)
    rows = rows.withColumn("cue", F.length(F.regexp_extract("hit", r"(?iuU)^(?:xét nghiệm|xn|kết quả)\s+", 0)))
    bare = T.squeeze(F.substring(F.col("hit"), F.col("cue") + 1, F.length("hit")))
    rows = rows.where((F.length(bare) <= 80) & ~F.lower(bare).isin(L.NOT_LABS) & bare.rlike(r"\p{L}"))
    return _both(rows.withColumn("start", F.col("start") + F.col("cue")), 0.72, "lab_generic_name_value", 0.78, "lab_generic_value")


def known_labs(notes: DataFrame, gen: int = 72) -> DataFrame:
    """D15, with case."""
    return spans(_shrink(found(notes, rf"(?Ud)(?<![{_WORD}])(?:{_KNOWN_LAB})(?![{_WORD}])", gen=gen), r"(?U:\s)"), "lab_test", 0.76, "lab_name")


def long_tests(notes: DataFrame, gen: int = 73) -> DataFrame:
    """D16."""
    return spans(_shrink(found(notes, rf"{_I}(?:{L.LONG_TESTS})", gen=gen), r"(?U:\s)"), "lab_test", 0.78, "lab_phrase")


def block_names(rows: DataFrame, column: str = "name") -> DataFrame:
    """`clean`, the name without a leading cue and a temporal suffix, `cut`, the characters gone from its start,
    and `usable`."""
    lead = F.length(F.regexp_extract(column, r"^[ \-*\t]*", 0))
    rows = rows.withColumn("_bare", F.substring(F.col(column), lead + 1, F.length(column))).withColumn("_cue", F.length(F.regexp_extract("_bare", r"(?iuU)^kết[ \t]+quả[ \t]+", 0)))
    rest = F.substring(F.col("_bare"), F.col("_cue") + 1, F.length("_bare"))
    rows = rows.withColumn("clean", F.regexp_replace(F.regexp_replace(rest, _I + L.BLOCK_SUFFIX, ""), r"[ \-*\t]+\z", "")).withColumn("cut", lead + F.col("_cue"))
    rows = rows.withColumn("_c", T.squeeze(F.btrim("clean", F.lit(" -*\t")))).withColumn("_f", T.folded(F.col("_c")))
    bad = reduce(Column.__or__, [F.col("_f").contains(cue) for cue in L.BLOCK_BAD_CUES])
    words = F.size(F.split(F.trim(F.substring_index("_c", "(", 1)), " "))
    stop = F.transform(F.array(*[F.lit(x) for x in L.NOT_LABS]), lambda x: T.folded(x))
    usable = F.length("_c").between(2, 70) & (words <= 5) & F.col("_c").rlike(r"\p{L}") & ~F.array_contains(stop, F.col("_f")) & ~F.col("_c").rlike("[.!?/]") & ~bad
    return rows.withColumn("usable", usable).drop("_bare", "_cue", "_c", "_f")


def structured_labs(notes: DataFrame, gen: int = 74) -> DataFrame:
    """In lines of lab blocks the first that fits of a verb pair, a colon pair and a bare pair."""
    lead = rf"{_I}^([ \t]*(?:[-*•][ \t]*)?(?:xét nghiệm[ \t]+)?)({L.BLOCK_NAME})"
    kinds = [
        lead + rf"([ \t]+(?:là|bằng|đạt|tăng lên|giảm còn|cải thiện thành)[ \t]+)({L.BLOCK_VALUE})",
        lead + rf"([ \t]*[:=][ \t]*)({L.BLOCK_VALUE})",
        lead + rf"([ \t]+)({L.BLOCK_VALUE})(?![.,]\d|[A-Za-z0-9])",
    ]
    rows = notes.where("raw_text IS NOT NULL").select(*notes.columns, F.posexplode(S.lab_lines(F.col("raw_text"))).alias("_i", "_l"))
    groups = lambda k: F.array(*[F.regexp_extract(F.col("_l.line"), kinds[k], g) for g in (1, 2, 3, 4)])
    use = F.when(F.col("_l.line").rlike(kinds[0]), groups(0)).when(F.col("_l.line").rlike(kinds[1]), groups(1)).when(F.col("_l.line").rlike(kinds[2]), groups(2))
    rows = rows.withColumn("_u", use).where("_u IS NOT NULL").withColumn("name", F.col("_u")[1])
    rows = block_names(rows).where("usable")
    name_at = F.col("_l.start") + F.length(F.col("_u")[0])
    value_at = name_at + F.length("name") + F.length(F.col("_u")[2])
    rows = rows.withColumns({"start": name_at + F.col("cut"), "v_start": value_at, "v_end": value_at + F.length(F.col("_u")[3]), "gen_ord": F.col("_i") * 2 + gen * _MILLION})
    return _both(rows.withColumn("end", F.col("start") + F.length("clean")), 0.84, "lab_structured_name", 0.84, "lab_structured_value")


def first_of_each(rows: DataFrame) -> DataFrame:
    """Of one (record, start, end, type) the first."""
    w = Window.partitionBy("record_id", "start", "end", "concept_type").orderBy("gen_ord")
    return rows.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def labs(notes: DataFrame) -> DataFrame:
    return first_of_each(union(lab_pairs(notes), generic_lab_pairs(notes), known_labs(notes), long_tests(notes), structured_labs(notes)))


# Record memory


def prefixed(code: Column, kind: Column) -> Column:
    """D22."""
    return F.when((kind == "drug") & code.rlike(r"(?U)^\d+\z"), F.concat(F.lit("Rx"), code)).when((kind == "diagnosis") & ~code.startswith("ICD10:"), F.concat(F.lit("ICD10:"), code)).otherwise(code)


_INTERNAL = {v: k for k, v in L.TYPE_LABELS.items()}


def internal_type(label: Column) -> Column:
    return F.coalesce(F.create_map(*[F.lit(x) for kv in _INTERNAL.items() for x in kv])[label], label)


def remembered(notes: DataFrame, memory: DataFrame) -> DataFrame:
    """From memory(record_id, sha1, spans array<entity>), the spans of notes whose id and SHA-1 of the text agree."""
    m = memory.select("record_id", F.col("sha1").alias("_sha"), F.posexplode("spans").alias("_i", "_e"))
    rows = notes.join(m, "record_id").where(F.sha1(F.col("raw_text").cast("binary")) == F.col("_sha"))
    return _payload(rows.withColumns({"start": F.col("_e.position")[0], "end": F.col("_e.position")[1], "gen_ord": F.col("_i")}), F.col("_e"), 0.995, "model_exact", F.col("_e.text"))


def _payload(rows: DataFrame, e: Column, confidence: float, source: str, text: Column | None = None) -> DataFrame:
    rows = rows.withColumn("_kind", internal_type(e["type"])).withColumn("_said", F.coalesce(e["assertions"], F.array().cast("array<string>")))
    cands = F.transform(F.coalesce(e["candidates"], F.array().cast("array<string>")), lambda c: F.struct(prefixed(c, F.col("_kind")).alias("id"), F.lit(None).cast("double").alias("score"), F.lit("model").alias("source")))
    return spans(rows, F.col("_kind"), confidence, source, 0, F.coalesce(F.get("_said", F.lit(0)), F.lit("")), F.col("_said"), cands, text)


def memory_lexicon(notes: DataFrame, lexicon_table: DataFrame) -> DataFrame:
    """(record_id, start, end, text, type, assertions, candidates): substrings of notes, case-blind, longest entries
    first (equal ones in the lexicon's order: lex_ord, or count descending and lower text), none overlapping an earlier
    one. Places (record_id, at) join the entries on three letters, so notes travel only with the places that can begin
    an entry; the occupancy is a fold in the note. Notes and places are never broadcast, whatever size the planner
    takes them for; a lexicon of up to _SMALL_LEXICON entries is."""
    columns = lexicon_table.columns
    order = [F.col("lex_ord")] if "lex_ord" in columns else [-F.col("count")] if "count" in columns else []
    lex = lexicon_table.where(F.length("text") >= 3).select(F.struct((-F.length("text")).alias("n"), *[c.alias("o") for c in order], F.lower("text").alias("l"), "text").alias("rank"), F.lower("text").alias("_low"), F.length("text").alias("_len"), "type", "assertions", "candidates")
    lex = lex.withColumn("_head", F.substring("_low", 1, 3))
    small = lexicon_table.limit(_SMALL_LEXICON + 1).count() <= _SMALL_LEXICON
    letters = notes.where(F.length("raw_text") >= 3).select("record_id", F.split("raw_text", "", -1).alias("_c"), F.split(F.lower("raw_text"), "", -1).alias("_l"), F.length("raw_text").alias("_n"), F.col("raw_text").rlike("[\u0130\u03a3]").alias("_odd"))
    join3 = lambda c, i: F.concat(F.get(c, i), F.get(c, i + 1), F.get(c, i + 2))
    every = F.sequence(F.lit(0), F.col("_n") - 3)
    # the letters whose lower case is longer or depends on the place are lowered by the three
    three = F.when(F.col("_odd"), F.transform(every, lambda i: F.substring(F.lower(join3("_c", i)), 1, 3))).otherwise(F.transform(every, lambda i: join3("_l", i)))
    places = letters.select("record_id", F.posexplode(three).alias("at", "_head"))
    near = places.join(F.broadcast(lex) if small else lex.hint("merge"), "_head").join(notes.select("record_id", "raw_text").hint("merge"), "record_id")
    here = F.substring(F.col("raw_text"), F.col("at") + 1, F.col("_len"))
    hit = near.where(F.lower(here) == F.col("_low"))
    each = F.struct("rank", F.col("at").cast("int").alias("start"), (F.col("at") + F.col("_len")).cast("int").alias("end"), here.alias("text"), "type", "assertions", "candidates")
    folded = hit.groupBy("record_id").agg(F.array_sort(F.collect_list(each)).alias("h"))
    taken = F.expr("aggregate(h, slice(h, 1, 0), (acc, x) -> CASE WHEN exists(acc, o -> greatest(o.start, x.start) < least(o.end, x.end)) THEN acc ELSE concat(acc, array(x)) END)")
    return folded.select("record_id", F.explode(taken).alias("x")).select("record_id", "x.start", "x.end", "x.text", "x.type", "x.assertions", "x.candidates")


def memory_lexicon_spans(notes: DataFrame, lexicon_table: DataFrame, gen: int = 1) -> DataFrame:
    """D21 and D22 as span rows."""
    hits = memory_lexicon(notes, lexicon_table).drop("text")
    rows = notes.join(hits, "record_id").withColumn("gen_ord", F.col("start") + gen * _MILLION).withColumn("_e", F.struct("type", "assertions", "candidates"))
    return _payload(rows, F.col("_e"), 0.78, "model_lexicon")


# Token models


def ner_type(label: Column) -> Column:
    """The first known label that the model's label contains."""
    up = F.regexp_replace(F.upper(label), "[BISE]-", "")
    out = F.when(F.lit(False), F.lit(""))
    for key, kind in L.NER_LABELS.items():
        out = out.when(up.contains(key), F.lit(kind))
    return out


def ner_spans(tokens: DataFrame, notes: DataFrame, min_score: float = 0.5, source: str = "transformer_ner", gap: int = 1, longest: int = 100) -> DataFrame:
    """From scored pieces (record_id, chunk_start, start, end, label, score) to spans: offsets shifted; weak and unknown
    ones and those that end behind the text dropped; the last of equal spans kept; neighbours of one type joined where
    nothing or one white space (`gap` at most) lies between and the whole has at most `longest` characters. The cap
    makes the join a fold in the note."""
    t = tokens.where(F.col("score") >= min_score).select("record_id", (F.col("chunk_start") + F.col("start")).cast("int").alias("start"), (F.col("chunk_start") + F.col("end")).cast("int").alias("end"), ner_type(F.col("label")).alias("concept_type"), F.col("score").cast("double").alias("confidence"), "chunk_start")
    t = t.where("concept_type IS NOT NULL AND start >= 0 AND start < end")
    last = t.groupBy("record_id", "start", "end", "concept_type").agg(F.max_by("confidence", "chunk_start").alias("confidence"))
    texts = notes.select("record_id", "raw_text")
    blank = F.substring(F.col("raw_text"), F.col("end") + 1, F.lit(gap)).rlike(r"(?U)^\s*\z")
    placed = last.join(texts, "record_id").where(F.col("end") <= F.length("raw_text")).withColumn("blank", blank)
    runs = placed.groupBy("record_id").agg(F.array_sort(F.collect_list(F.struct("start", "end", "concept_type", "confidence", "blank"))).alias("s"))
    joins = f"size(acc) > 0 AND element_at(acc, -1).concept_type = x.concept_type AND (x.start = element_at(acc, -1).end OR (x.start - element_at(acc, -1).end BETWEEN 1 AND {gap} AND element_at(acc, -1).blank)) AND x.end - element_at(acc, -1).start <= {longest}"
    fold = F.expr(f"aggregate(s, slice(s, 1, 0), (acc, x) -> CASE WHEN {joins} THEN concat(slice(acc, 1, size(acc) - 1), array(named_struct('start', element_at(acc, -1).start, 'end', x.end, 'concept_type', x.concept_type, 'confidence', least(x.confidence, element_at(acc, -1).confidence), 'blank', x.blank))) ELSE concat(acc, array(x)) END)")
    j = runs.select("record_id", F.explode(fold).alias("x")).join(texts, "record_id")
    return j.select("record_id", "x.start", "x.end", T.cut(F.col("raw_text"), F.col("x.start"), F.col("x.end")).alias("text"), "x.concept_type", "x.confidence", F.lit(source).alias("source"))


def rules(notes: DataFrame, drug_names: list[str] | None = None, diagnosis_names: list[str] | None = None) -> DataFrame:
    """D29's rule part: drugs, then problems, then labs."""
    names = sorted(set(L.DRUGS) | set(drug_names or []))
    return union(dosed_drugs(notes, names), drug_aliases(notes, names), cued_drugs(notes, names), diagnosis_lexicon(notes, diagnosis_names), symptom_lexicon(notes), cued_diagnoses(notes), cued_symptoms(notes), labs(notes))
