"""The ten operators against brute force and on hostile rows: nulls, empty and long texts, ties, repeated rows, empty
tables, clashing columns."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from marginalia.llm import apportion, components, decontaminate, kit, kneser_ney, language_id, lsh_forest, metric_join, passages, token_counts, warc, winnowing
from marginalia.llm.queries import tokenizer

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, sig string, k1 long, size int, n long"


def words(rng, n, letters="abcdefgh"):
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 6))) for _ in range(n))


def hostile(spark, extra=()):
    """Rows with every kind of trouble, and columns named like the operators' own."""
    rng = random.Random(5)
    base = words(rng, 60)
    long = words(rng, 6000)
    texts = [base, base, base + " tail", None, "", " \t\n", "one", "One", "ONE", long, "\n".join([base] * 3), "ä é ü ß", *extra]
    rows = [(i, t, "en" if i % 3 else None, f"s{i % 2}" if i % 4 else None) for i, t in enumerate(texts)]
    rows += [(1, base, "en", "s1"), (None, base, "en", None), (None, None, None, None)]
    return spark.createDataFrame([(*r, 0, "x", 7, 1, 2) for r in rows], SCHEMA)


def roots(n, links):
    p = list(range(n))

    def f(x):
        while p[x] != x:
            x = p[x]
        return x

    for a, b in links:
        a, b = f(a), f(b)
        p[max(a, b)] = min(a, b)
    return [f(i) for i in range(n)]


def test_kit_words_and_hashes():
    import pyarrow as pa

    texts = ["A b\tc", "", None, "é b", "b"]
    d, o = kit.buffers(pa.array(texts))
    s, e, f = kit.words(kit.LOWER[d], o, kit.NONSPACE)
    assert np.diff(f).tolist() == [3, 0, 0, 2, 1]
    h = kit.span_hashes(kit.LOWER[d], s, e, kit.Powers())
    assert h[1] == h[4] == h[5] and len(set(h.tolist())) == 4
    sh, sf = kit.shingles(h, f, 2)
    assert np.diff(sf).tolist() == [2, 0, 0, 1, 1]


def test_components(spark):
    links = [(1, 2), (3, 2), (5, 9), (9, 7), (4, 4), (None, 8)] + [(20 + i, 21 + i) for i in range(30)]
    got = {r.id: r.component for r in components.components(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()}
    assert got == {1: 1, 2: 1, 3: 1, 5: 5, 7: 5, 9: 5} | {i: 20 for i in range(20, 51)}
    assert components.components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


def test_warc_audit(spark):
    rows = [(i, f"http://x/{i}", f"<p>{i} é" if i % 7 else None, "clash") for i in range(300)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, digest string")
    rec = warc.archive_records(pages, per_archive=100).persist()
    first = rec.where("ordinal = 0").first()
    assert bytes(first.record).startswith(b"WARC/1.0\r\n") and first.length == len(first.record) and first.offset == 0
    bad = rec.where("ordinal <> 130").withColumn("record", F.when(F.col("ordinal").isin(5, 250), F.lit(b"?")).otherwise(F.col("record")))
    a, b = warc.merkle_tree(rec, 4), warc.merkle_tree(bad, 4)
    assert warc.audit(a, warc.merkle_tree(rec, 4), 4).count() == 0
    got = {(r.ordinal, r.verdict) for r in warc.audit(a, b, 4).collect() if r.verdict == "corrupt" and r.ordinal in (5, 250)}
    assert got == {(5, "corrupt"), (250, "corrupt")}
    assert warc.audit(a, b, 4).where("ordinal >= 130 AND ordinal < 200").count() > 0
    leaf = a[0].where("node = 3 AND archive = 0").first()
    assert leaf.digest == hashlib.sha256(bytes(rec.where("ordinal = 3").first().record)).hexdigest()
    none = warc.merkle_tree(rec.limit(0), 4)
    assert warc.audit(none, none, 4).count() == 0


def test_warc_files(spark, tmp_path):
    pages = spark.createDataFrame([(1, "http://a", "x"), (2, "http://b", "yy")], "page_id long, url string, html string")
    rec = warc.archive_records(pages)
    (tmp_path / "a.warc").write_bytes(b"".join(bytes(r.record) for r in rec.orderBy("ordinal").collect()))
    got = warc.read_warc(spark, str(tmp_path / "a.warc")).orderBy("ordinal").collect()
    assert [(r.uri, r.offset, r.length) for r in got] == [("http://a", 0, got[0].length), ("http://b", got[0].length, got[1].length)]


def test_block_max_wand_finds_all():
    rng = random.Random(1)
    for _ in range(60):
        items = [(k, " ".join("w%d" % (int(rng.paretovariate(0.6)) % 60) for _ in range(rng.randint(3, 12))), None) for k in range(120)]
        index = decontaminate.build_index(items, 0.5)
        q = np.unique(decontaminate._tokens([" ".join("w%d" % rng.randint(0, 60) for _ in range(25))])[0]).tolist()
        score = {}
        for w in q:
            for j, x in zip(*index["post"].get(w, ([], []))[:2]):
                score[j] = score.get(j, 0) + x
        assert {j for j, x in score.items() if x >= 0.5} == {j for j, x in decontaminate.block_max_wand(index["post"], q, 0.5)}


def test_decontamination(spark):
    rng = random.Random(2)
    items = [(i, words(rng, 12) + ". " + words(rng, 12) + ".") for i in range(30)] + [(90, None), (91, ""), (92, "Zq xv")]
    plant = lambda i: words(rng, 90) + " " + items[i][1].upper() + words(rng, 70)
    docs = hostile(spark, [plant(3), plant(7), items[9][1][: len(items[9][1]) // 2], words(rng, 400), "so zq XV it is"])
    b = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(docs, b).collect()}
    assert got == {(12, 3), (13, 7), (16, 92)}
    kept = decontaminate.drop_contaminated(docs, b)
    assert kept.columns == docs.columns and kept.count() == docs.count() - 3
    assert decontaminate.contaminated(docs, b.limit(0)).count() == 0
    assert decontaminate.contaminated(docs.limit(0), b).count() == 0
    # answers must overlap too; blocks of the index give the same
    qa = spark.createDataFrame([(1, items[3][1], "not there at all"), (2, items[3][1], items[7][1])], "item_id long, q string, a string")
    assert decontaminate.contaminated(docs, qa, question_col="q", answer_col="a").count() == 0
    assert {(r.doc_id, r.item_id) for r in decontaminate.contaminated(docs, b, index_bytes=20_000).collect()} == got


def test_metric_join(spark):
    rng = np.random.RandomState(3)
    base = rng.randn(40, 16)
    v = np.concatenate([base[rng.randint(0, 40, 300)] + 0.12 * rng.randn(300, 16), rng.randn(150, 16)])
    v = np.concatenate([v, v[:20] * 3.0, v[:5]]).astype(np.float32)
    rows = [(i, x.tolist(), 1, "c") for i, x in enumerate(v)]
    odd = [(9001, None, 0, "c"), (9002, [0.0] * 16, 0, "c"), (9003, [float("nan")] * 16, 0, "c"), (9004, [], 0, "c"), (9005, [1.0, 2.0], 0, "c"), (None, [1.0] * 16, 0, "c")]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>, label int, cell string")
    got = {r.vec_id: r for r in metric_join.range_join(df, tile=64).collect()}
    x = v.astype(np.float64)
    n = np.linalg.norm(x, axis=1)
    g = (x @ x.T) / np.outer(n, n) >= 0.9
    np.fill_diagonal(g, False)
    c = roots(len(v), zip(*np.nonzero(g)))
    sure = np.abs((x @ x.T) / np.outer(n, n) - 0.9).min(axis=1) > 1e-9
    assert all(got[i].n_links == g[i].sum() and got[i].component_id == c[i] and got[i].kept == (c[i] == i) for i in np.flatnonzero(sure))
    assert all(got[i].n_links == 0 and got[i].component_id == i for i in (9001, 9002, 9003, 9004, 9005))
    assert got[None].component_id is None and got[None].kept
    assert metric_join.range_join(df.limit(0)).count() == 0


def test_language_id(spark):
    rng = random.Random(4)
    alphabets = {"aa": "abcde", "bb": "fghij", "cc": "klmno"}
    extra = [(100 + i, words(rng, 50, alphabets[k]), k, "s", 0, "x", 1, 1, 1) for i in range(90) for k in [list(alphabets)[i % 3]]]
    docs = spark.createDataFrame(extra, SCHEMA).union(hostile(spark).withColumn("lang", F.lit(None).cast("string")))
    rows = language_id.identify_languages(docs, docs_per_language=8).collect()
    assert len(rows) == docs.count()
    want = {r[0]: r[2] for r in extra}
    assert all(r.lang_pred == want[r.doc_id] and 0 <= r.score <= 1 for r in rows if r.doc_id in want)
    assert all(r.lang_pred == "und" and r.score == 0 for r in rows if r.doc_id in (3, 4, 5))
    assert language_id.identify_languages(docs.withColumn("lang", F.lit(None).cast("string"))).where("lang_pred <> 'und'").count() == 0
    assert language_id.identify_languages(docs.limit(0)).count() == 0


def test_cross_parsing_counts_phrases():
    lut = language_id.byte_classes()
    code = lambda s: lut[np.frombuffer(s, np.uint8)]
    sample = b"abcabdxyz"
    table = language_id.parse_table(np.array(language_id.suffix_automaton(code(sample).tolist()), np.int32))

    def brute(text):
        n, at = 0, 0
        while at < len(text):
            k = 1
            while at + k < len(text) and text[at : at + k + 1] in sample:
                k += 1
            n, at = n + 1, at + k
        return n

    rng = random.Random(6)
    for _ in range(40):
        t = bytes(rng.choice(b"abcdxyzq") for _ in range(rng.randint(1, 40)))
        got = language_id.phrases(code(t).astype(np.int32), np.array([0, len(t)]), [table])[0, 0]
        assert got == brute(t), t


@pytest.mark.parametrize("sample", [0, 50])
def test_token_counts(spark, sample):
    import sentencepiece

    path = tokenizer("piece_bpe_32k.model")
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    odd = [" ", "   ", "a  b ", "\n", " \n x", "▁▁x ▁", "<s> </s> <unk> <0x0A>", "日本語 テスト 😀", "\t\t a", "x" * 3000, "a b　c", "a\x00b", "\r\n);\r", "²."]
    docs = hostile(spark, odd)
    rows = token_counts.count_tokens(docs, path, limit=100, sample=sample).collect()
    want = sorted((str(r.doc_id), len((r.text or "").encode()), len(sp.encode(r.text or ""))) for r in docs.collect())
    assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens) for r in rows) == want
    assert all(r.over_limit == (r.n_tokens > 100) for r in rows)


def test_passages(spark):
    rng = random.Random(3)
    p = words(rng, 52)
    docs = [(i, words(rng, rng.randint(5, 40)) + " " + p + " " + words(rng, 30) + "\n" + words(rng, 20)) for i in range(30)] + [(100 + i, words(rng, 120)) for i in range(30)]
    line = words(rng, 40).split()
    near = line[:39] + ["changed"]
    docs += [(200, " ".join(line)), (201, " ".join(near)), (300, None), (301, ""), (None, p), (302, "\n\n"), (303, words(rng, 3000))]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.doc_id: r for r in passages.repeated_passages(df).collect()}
    assert set(got) == set(range(1, 30)) | {201}
    assert got[201].first_ids == [200] and got[201].spans[0].start == 0
    assert all(0 in got[i].first_ids for i in range(1, 30))
    cut = {r.doc_id: r.text for r in passages.cut_passages(df).collect()}
    assert len(cut) == len(docs) and cut[0] == docs[0][1] and all(p not in cut[i] for i in range(1, 30)) and cut[201] == ""
    assert passages.repeated_passages(df.limit(0)).count() == 0


def test_kneser_ney(spark):
    rng = random.Random(8)
    good = [(i, words(rng, 80), "en" if i % 2 else "fr", i % 3) for i in range(200)]
    junk = [(500 + i, "".join(rng.choice("#$%&*@|!?0123XYZ") for _ in range(300)), "en", 0) for i in range(10)]
    rows = good + junk + [(900, None, "en", 0), (901, "", None, 0), (None, "abc", None, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, n int")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(0, 200, 2)] + [(1, 1, 0), (None, 1, 0), (3, 1, None), (501, 0, 0)], "doc_id long, quality int, toxic int")
    out = {r.doc_id: r for r in kneser_ney.classify(docs, labels).collect()}
    assert {i for i, r in out.items() if r.rejected} == {r[0] for r in junk}
    kept = kneser_ney.keep_fluent(docs, labels)
    assert kept.columns == docs.columns and kept.count() == len(rows) - len(junk)
    assert kneser_ney.classify(docs, labels.limit(0)).where("rejected").count() == 0
    assert kneser_ney.classify(docs.limit(0), labels).count() == 0


def _plain_kneser_ney(texts, order=5):
    """-ln p of (context, byte) by the definition, one n-gram at a time."""
    counts = {order: {}}
    for t in texts:
        t = (0,) * (order - 1) + tuple(t.encode())
        for i in range(order - 1, len(t)):
            g = t[i - order + 1 : i + 1]
            counts[order][g] = counts[order].get(g, 0) + 1
    for k in range(order - 1, 0, -1):
        counts[k] = {}
        for g in counts[k + 1]:
            counts[k][g[1:]] = counts[k].get(g[1:], 0) + 1
    cuts, below = {}, {}
    for k, c in counts.items():
        n = [sum(v == j for v in c.values()) for j in (1, 2, 3, 4)]
        y = n[0] / (n[0] + 2 * n[1]) if n[0] + n[1] else 0.5
        cuts[k] = [min(j, max(0.0, j - (j + 1) * y * n[j] / n[j - 1])) if n[j - 1] and n[j] else 0.5 * j for j in (1, 2, 3)]
        below[k] = {}
        for g, v in c.items():
            total, cut = below[k].get(g[:-1], (0, 0))
            below[k][g[:-1]] = total + v, cut + cuts[k][min(v, 3) - 1]

    def p(g):
        if not g:
            return 1 / 256
        k, rest = len(g), p(g[1:])
        if g[:-1] not in below[k]:
            return rest
        total, cut = below[k][g[:-1]]
        v = counts[k].get(g, 0)
        return (v - cuts[k][min(v, 3) - 1] if v else 0) / total + cut / total * rest

    return lambda g: -np.log(p(g))


def test_kneser_ney_equals_its_definition(spark, monkeypatch):
    monkeypatch.setattr(kneser_ney, "BLOCK", 700)
    monkeypatch.setattr(kneser_ney, "SHARED", 1)
    rng = random.Random(9)
    trusted = [words(rng, 60) for _ in range(12)] + ["", "été naïve 日本語", "a"]
    docs = [(i, words(rng, 40)) for i in range(40)] + [(40, None), (41, ""), (42, "日本語 ok"), (42, "Zzq#"), (None, trusted[0]), (43, "x" * 20000)] + [(50 + i, trusted[1]) for i in range(30)]
    model = kneser_ney.train(spark.createDataFrame([(t,) for t in trusted], "_text string"))
    plain, memo = _plain_kneser_ney(trusted), {}
    want = []
    for i, t in docs:
        raw = (0,) * 4 + tuple((t or "").encode())
        gs = [raw[j - 4 : j + 1] for j in range(4, len(raw))]
        for g in gs:
            memo[g] = memo[g] if g in memo else plain(g)
        want.append((-1 if i is None else i, len(gs), round(sum(memo[g] for g in gs), 1)))
    got = kneser_ney.score(spark.createDataFrame(docs, "_id long, _text string").repartition(3), *model, ["_id"])
    found = [(-1 if r._id is None else r._id, r.n, r.total) for r in got.collect()]
    assert len(found) == len(want)
    for w, f in zip(sorted(want), sorted(found)):
        assert w[:2] == f[:2] and abs(w[2] - f[2]) < 0.06 + 1e-5 * w[2]
    assert abs(model[0].reshape(256, 256).sum(axis=1) - 1).max() < 1e-9


def test_lsh_forest(spark):
    rng = random.Random(10)
    texts = []
    for _ in range(12):
        w = words(rng, 60).split()
        for _ in range(8):
            x = list(w)
            for _ in range(rng.randint(0, 6)):
                x[rng.randrange(len(x))] = words(rng, 1)
            texts.append(" ".join(x))
    docs = hostile(spark, texts)
    got = {r.doc_id: r for r in lsh_forest.near_duplicates(docs, small=4).where("doc_id IS NOT NULL").collect()}
    rows = sorted({(r.doc_id, r.text) for r in docs.collect() if r.doc_id is not None})
    sets = []
    for _, t in rows:
        w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append({tuple(w[i : i + 2]) for i in range(len(w) - 1)} or ({tuple(w)} if w else set()))
    links = [(i, j) for i in range(len(sets)) for j in range(i) if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
    c = roots(len(sets), links)
    assert len(links) > 30
    for i, (doc, _) in enumerate(rows):
        assert (got[doc].n_shingles, got[doc].component_id) == (len(sets[i]), rows[c[i]][0])
    assert lsh_forest.near_duplicates(docs.limit(0)).count() == 0
    kept = lsh_forest.drop_near_duplicates(docs)
    assert kept.columns == docs.columns


def test_winnowing(spark):
    rng = random.Random(11)
    a, b, c, d = (words(rng, 12) for _ in range(4))
    texts = [f"{a}\n{b}\n{c}", f"x\n{b}\n{c}\nend", f"{a}\n{c}", f"{a}\n{b}", "a\nb", "a\nb", f"{d}\n{d}\n{d}", None, "", f"{a}\n{b}\n{c}"]
    docs = spark.createDataFrame([(i, t, "u", 1) for i, t in enumerate(texts)] + [(None, texts[0], "u", 1)], "doc_id long, text string, removed string, gone int")
    out = {r.doc_id: r for r in winnowing.dedup_lines(docs).collect()}
    assert [out[i].removed for i in range(10)] == [[], [1, 2], [], [0, 1], [], [], [1, 2], [], [], [0, 1, 2]]
    assert out[1].text == "x\nend" and out[6].text == d and out[7].text is None and out[None].n_removed == 0
    left = winnowing.drop_repeated_runs(docs)
    assert left.columns == docs.columns and left.where("removed <> 'u'").isEmpty()
    kept = {r.doc_id for r in left.collect()}
    assert kept == {0, 1, 2, 4, 5, 6, 7, 8, None}
    alone = {r.doc_id: r.removed for r in winnowing.dedup_lines(docs, line_bytes=winnowing.MIN_BYTES).collect()}
    assert [alone[i] for i in range(10)] == [[], [1, 2], [0, 1], [0, 1], [], [], [1, 2], [], [], [0, 1, 2]]
    assert alone[None] == []
    assert winnowing.dedup_lines(docs.limit(0)).count() == 0


def test_apportionment(spark):
    rng = random.Random(12)
    rows = [(i, words(rng, rng.randint(0, 200)) if i % 9 else None, f"s{min(i % 7, 3)}" if i % 11 else None, 0, "u", 1) for i in range(400)] + [(5, "a b c", "s1", 0, "u", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, size int, unit string, taken int")
    out = apportion.mix_documents(docs, shard_words=2000).toPandas()
    assert len(out) == len(rows) and (out.taken <= 2 * out["size"]).all() and (out.taken >= 0).all()
    by = out.groupby(out.source.fillna("~")).agg(size=("size", "sum"), target=("target", "first"), taken=("taken", "sum")).sort_index()
    total, left, w = by["size"].sum(), 1.5 * by["size"].sum(), dict(zip(by.index, [3, 1, 2, 3, 1]))
    open_, want = set(by.index), {}
    while open_:
        level = left / sum(w[s] for s in open_)
        full = {s for s in open_ if w[s] * level > 2 * by["size"][s]}
        for s in full or open_:
            want[s] = 2 * by["size"][s] if full else w[s] * level
            left -= want[s]
        open_ -= full or set(open_)
    assert all(abs(by.target[s] - want[s]) < 1e-6 for s in by.index)
    assert (by.taken - by.target).abs().max() <= 8 * 12 and abs(by.target.sum() - 1.5 * total) < 1e-6
    again = apportion.mix_documents(docs, shard_words=2000).toPandas()
    key = ["doc_id", "size", "taken"]
    assert out[key].sort_values(key).values.tolist() == again[key].sort_values(key).values.tolist()
    assert apportion.mix_documents(docs.limit(0)).count() == 0


def test_sainte_lague_by_quotients(spark):
    rng = random.Random(13)
    values = [(f"u{i:02d}", float(rng.choice([0, 1, 5, 5, 100, 731])), rng.choice([2, 50, 1000])) for i in range(20)]
    units = spark.createDataFrame(values, "unit string, value double, most long")
    for seats in (0, 1, 7, 40, 200):
        quotients = sorted(((-v / (2 * k - 1), u) for u, v, m in values if v for k in range(1, m + 1)))[:seats]
        want = {u: 0 for u, _, _ in values}
        for _, u in quotients:
            want[u] += 1
        got = {r.unit: r.seats for r in apportion.sainte_lague(units, seats).collect()}
        assert got == want, seats


def test_pipeline_stages(spark, tmp_path):
    import corpus_pipeline

    assert [n for n, _ in corpus_pipeline.STAGES][:2] == ["quality classifier", "line dedup"] and len(corpus_pipeline.STAGES) == 5
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert set(out.columns) == {"doc_id", "size", "source_size", "target", "taken"} and 0 < out.count() <= docs.count()


def templated(rng, partners, core, slots, moved):
    """Texts of one template with three-valued slots; each has a partner that differs in `moved` slots."""
    head, seps = " ".join(f"core{i}" for i in range(core)), [f"sep{i}" for i in range(slots)]
    out = []
    for _ in range(partners):
        v = [rng.randrange(3) for _ in seps]
        w = list(v)
        for i in rng.sample(range(slots), moved):
            w[i] = (w[i] + rng.randint(1, 2)) % 3
        out += [head + " " + " ".join(f"{s} v{s}x{x}" for s, x in zip(seps, u)) for u in (v, w)]
    return out


def brute_roots(texts, k, threshold):
    """Components of all pairs by the Jaccard of their k-word shingles."""
    number, sets = {}, []
    for t in texts:
        w = t.split()
        sets.append({number.setdefault(tuple(w[i : i + k]), len(number)) for i in range(len(w) - k + 1)})
    m = np.zeros((len(texts), len(number)), np.float32)
    for i, s in enumerate(sets):
        m[i, list(s)] = 1
    both, n = m @ m.T, m.sum(axis=1)
    hit = np.triu(100 * both >= threshold * (n[:, None] + n[None, :] - both), 1)
    return roots(len(texts), zip(*np.nonzero(hit))), int(hit.sum())


def test_lsh_forest_in_crowded_regions(spark):
    texts = templated(random.Random(14), 1000, 121, 30, 9)
    want, links = brute_roots(texts, 2, 80)
    assert links >= 1000 and len(set(want)) > 500
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in lsh_forest.near_duplicates(docs).collect()}
    assert [got[i] for i in range(len(texts))] == want


def test_passages_in_crowded_bands(spark):
    texts = templated(random.Random(15), 600, 124, 30, 3)
    want, links = brute_roots(texts, 5, 80)
    assert links >= 600 and len(set(want)) > 300
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    whole = passages.repeats(docs).groupBy("doc_id").agg(F.max(F.when((F.col("start") == 0) & (F.col("first_start") == 0), F.struct("end", "first_id"))).alias("x"))
    got = {r.doc_id: r.x.first_id for r in whole.collect() if r.x and r.x.end == len(texts[r.doc_id])}
    assert [got.get(i, i) for i in range(len(texts))] == want


def test_line_dedup_of_single_lines(spark):
    from marginalia.llm import stages

    rng = random.Random(16)
    a, long = words(rng, 14), words(rng, 60)
    texts = [f"x{i}\n{long if i % 2 else a}\ny{i}" for i in range(30)] + [long, None, "", "ab", "ab", f"{a}\n{a}", f"u\nv\n{a}"]
    texts += ["p\n" + "\n".join(["short one", "short two", "short three with some words and more"])] * 2
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    size = lambda x: len(re.sub("[ \t\r]", "", x).encode())
    seen, want = set(), {}
    for i, t in enumerate(texts):
        l = (t or "").split("\n")
        runs = [(j, k, tuple(l[j : j + k])) for j in range(len(l)) for k in (1, 2) if j + k <= len(l)]
        gone = set()
        for j, k, run in runs:
            if sum(map(size, run)) >= 40:
                gone |= set(range(j, j + k)) if run in seen else set()
                seen.add(run)
        left = "\n".join(x for j, x in enumerate(l) if j not in gone)
        if t is None or not gone or left.strip():
            want[i] = t if t is None else left
    got = {r.doc_id: r.text for r in stages.line_dedup(spark, docs, "").collect()}
    assert got == want and got[3] == "x3\ny3" and 30 not in got
