"""Each operator against a brute-force version on a small fixture, with the odd cases the docstrings define."""

import hashlib
import itertools
import os
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabcast.llm import chat, embedding_dedup, language_id, mixing, nearest, ngram_join, packing, pii, toxicity, warc
from tabcast.llm.common import components, split_rank
from tabcast.llm.queries import conversation_events, tokenizer_path

DOCS = "doc_id long, text string, lang string, source string, n_chars long, size int, row string, spans int"


def _rows(pairs):
    """Documents with extra columns whose names the operators use themselves."""
    return [(i, t, "en", s, len(t) if t else 0, 1, "x", 2) for i, t, s in pairs]


def _vocabulary(n, seed=1):
    r = random.Random(seed)
    return ["".join(r.choice("abcdefgh") for _ in range(5)) for _ in range(n)]


@pytest.fixture(scope="module")
def corpus():
    """(id, text, source): near and exact copies, repeated rows, nulls, empty, short and very long texts."""
    r, words = random.Random(7), _vocabulary(800)
    out = []
    for i in range(40):
        out.append((i, " ".join(r.choices(words, k=600 if i == 5 else r.randint(30, 120))), f"s{i % 3}"))
    base = out[5][1].split()
    for i in range(40, 60):  # near copies, some just beyond the threshold
        w = list(base)
        for _ in range(i - 39):
            w[r.randrange(len(w))] = r.choice(words)
        out.append((i, " ".join(w), None))
    out += [(60, out[0][1], "s0"), (61, out[0][1].upper(), "s1"), (62, "", "s0"), (63, None, "s0"), (64, "one two", None)]
    out += [(65, "one  two\n", "s2"), (66, " \t\n", "s2"), (67, " ".join(r.choices(words, k=30_000)), "s1"), (3, out[3][1], "s0")]
    out += [(None, "a null id", "s0"), (68, "één Straße ünïcode", "é")]
    return out


def _shingles(text, width):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i : i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} if w else set()


def _reach(nodes, links):
    low = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            m = min(low[a], low[b])
            changed |= low[a] != m or low[b] != m
            low[a] = low[b] = m
    return low


def test_ngram_join_is_exact(spark, corpus, monkeypatch):
    width, percent = 4, 85
    monkeypatch.setattr(ngram_join, "BLOCK", 4)  # small blocks: buckets are cut
    docs = spark.createDataFrame(_rows(corpus), DOCS)
    got = ngram_join.ngram_jaccard_join(docs, width=width, percent=percent).collect()
    sets = {i: _shingles(t, width) for i, t, _ in corpus if i is not None}
    links = [
        (a, b) for a, b in itertools.combinations(sets, 2) if sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
    ]
    low = _reach(sets, links)
    assert len(got) == len(corpus)
    assert {(r["doc_id"], r["n_shingles"], r["component_id"]) for r in got if r["doc_id"] is not None} == {(i, len(s), low[i]) for i, s in sets.items()}
    assert [(r["n_shingles"], r["component_id"]) for r in got if r["doc_id"] is None] == [(1, None)]
    assert len(links) > 20 and low[61] == 0 and low[62] == 62


def test_ngram_join_in_many_parts_is_the_same(spark, corpus, monkeypatch):
    some = corpus[:8] + corpus[40:48] + corpus[60:67] + [(1000 + i, t, "x") for i, t, _ in corpus[:8] for _ in range(2)]
    docs = spark.createDataFrame(_rows(some), DOCS)
    want = sorted(map(str, ngram_join.ngram_jaccard_join(docs).collect()))
    for name, value in (("BROADCAST_IDS", 0), ("PAIRS_AT_A_TIME", 10), ("TOKENS_A_SHARE", 800)):
        monkeypatch.setattr(ngram_join, name, value)
    assert sorted(map(str, ngram_join.ngram_jaccard_join(docs).collect())) == want
    # More copies than can be sent to every task, and fewer of what stays.
    copied = spark.createDataFrame(_rows([(i + 100 * k, t, s) for i, t, s in corpus[:4] for k in range(6)] + [(None, "a b", "s")] * 2), DOCS)
    monkeypatch.setattr(ngram_join, "BROADCAST_IDS", 5)
    assert sorted(map(str, ngram_join.one_of_each(copied).select("doc_id").toPandas()["doc_id"])) == ["0.0", "1.0", "2.0", "3.0", "nan", "nan"]


def test_ngram_join_leaves_little_on_disk(spark, corpus, monkeypatch):
    """Texts and sets are gone once nothing reads them; sizes and links stay."""
    from tabcast.session import scratch_path

    made = []
    monkeypatch.setattr("tabcast.session.scratch_path", lambda s, name: made.append(scratch_path(s, name)) or made[-1])
    out = ngram_join.ngram_jaccard_join(spark.createDataFrame(_rows(corpus), DOCS))
    left = {os.path.basename(p).rpartition("-")[0] for p in made if os.path.exists(p.removeprefix("file:"))}
    assert "join-sizes" in left and not left & {"join-sets", "join-buckets", "join-texts", "join-orders", "join-left", "join-bitmaps", "join-pairs"}
    assert out.count() == len(corpus)


def test_one_of_each_keeps_one_row_of_a_group(spark, corpus):
    docs = spark.createDataFrame(_rows(corpus), DOCS)
    kept = ngram_join.one_of_each(docs)
    ids = [r["doc_id"] for r in kept.collect()]
    assert kept.columns == docs.columns
    assert ids.count(3) == 1 and ids.count(None) == 1 and 0 in ids and not {60, 61} & set(ids) and {62, 63, 66} <= set(ids)


def test_shingle_hashes_tell_texts_apart():
    texts = ["a b c d", "a b c d ", "b a c d", "ab c d", "A B c D", "ab", "a b", "", "ba"]
    import pyarrow as pa

    sets = [tuple(s.tolist()) for _, s in ngram_join._text_sets(pa.array(texts), 4)]
    assert sets[0] == sets[1] == sets[4] and sets[7] == ()
    assert len(set(sets)) == len(texts) - 2


def test_components_of_a_path_a_star_and_loops(spark):
    edges = [(i, i + 1) for i in range(0, 30)] + [(100, i) for i in range(101, 130)] + [(7, 7), (None, 3)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(31)}, **{i: 100 for i in range(100, 130)}}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_split_rank_numbers_every_group(spark):
    df = spark.range(1000).selectExpr("id", "id % 3 = 0 as g", "cast(id % 7 as int) as b")
    got = split_rank(df, ["g"], "b", [F.col("id")], "r").groupBy("g").agg(F.sort_array(F.collect_list("r")).alias("r")).collect()
    assert all(r["r"] == list(range(len(r["r"]))) for r in got)


def _mix_targets(sizes):
    weights = {s: 1 + i % 3 for i, s in enumerate(sorted(sizes, key=lambda s: (s is None, s or "")))}
    total, stopped = sum(sizes.values()), set()
    while True:
        left = total - sum(3 * sizes[s] for s in stopped)
        free = sum(w for s, w in weights.items() if s not in stopped)
        over = {s for s in sizes if s not in stopped and left * weights[s] / free > 3 * sizes[s]}
        if not over:
            return {s: 3.0 * sizes[s] if s in stopped else left * weights[s] / free for s in sizes}
        stopped |= over


def test_mixing_meets_targets(spark, corpus):
    docs = spark.createDataFrame(_rows(corpus), DOCS)
    got = mixing.mix(docs).collect()
    assert len(got) == len(corpus)
    sizes = {}
    for _, t, s in corpus:
        sizes[s] = sizes.get(s, 0) + len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    for s, target in _mix_targets(sizes).items():
        rows = [r for r in got if r["source"] == s]
        assert all(abs(r["target"] - target) < 1e-6 and r["source_size"] == sizes[s] and 0 <= r["taken"] <= 3 * r["size"] for r in rows)
        assert abs(sum(r["taken"] for r in rows) - target) <= 1
    again = mixing.mix(docs.repartition(5)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_mixed_documents_hold_the_words_taken(spark, corpus):
    rows = list({r[0]: r for r in corpus if r[0] is not None}.values())
    docs = spark.createDataFrame(_rows(rows), DOCS)
    taken = {r["doc_id"]: r["taken"] for r in mixing.mix(docs).collect()}
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns and out.dtypes == docs.dtypes
    words = {}
    for r in out.collect():
        words[r["doc_id"]] = words.get(r["doc_id"], 0) + len((r["text"] or "").split())
    assert words == {i: n for i, n in taken.items() if n}


def test_mixed_documents_take_rows_without_an_id_each(spark):
    r, words = random.Random(9), _vocabulary(200)
    rows = [(None, " ".join(r.choices(words, k=20 + i % 3)), f"s{i % 2}") for i in range(30)]
    rows += [(7, " ".join(r.choices(words, k=25)), "s0") for _ in range(4)] + [(8, "same text", "s1")] * 3 + [(None, None, None)]
    docs = spark.createDataFrame(_rows(rows), DOCS)
    total = sum(x["taken"] for x in mixing.mix(docs).collect())
    out = mixing.mixed_documents(docs)
    assert out.dtypes == docs.dtypes
    got = out.collect()
    assert sum(len(x["text"].split()) for x in got) == total
    # Every text is a whole one or the beginning of one, and none comes more often than a source is repeated at most.
    texts = [t for _, t, _ in rows if t]
    assert all(any(t.startswith(x["text"]) for t in texts) for x in got)
    assert all(sum(t.startswith(x["text"]) for x in got) <= 3 * texts.count(t) for t in texts)
    assert all(x["n_chars"] == len(x["text"]) for x in got)


def test_packing_covers_every_id_once(spark, corpus):
    from tokenizers import Tokenizer

    texts = [*corpus, (90, "odd <|endoftext|> text\x1cİstanbul ΣΑΣ é  it's 42  x", "s0")]
    got = [r.asDict() for r in packing.pack(spark.createDataFrame(_rows(texts), DOCS), tokenizer_path(), buckets=3).collect()]
    tok = Tokenizer.from_file(tokenizer_path())
    want = []
    for i, t, _ in texts:
        ids = np.array([*tok.encode(t or "", add_special_tokens=False).ids, 1], dtype="<u4")
        want += [(i, a, len(ids[a : a + 2048]), zlib.crc32(ids[a : a + 2048].tobytes()), len(ids)) for a in range(0, len(ids), 2048)]
    key = lambda x: tuple(-1 if v is None else v for v in x)
    assert sorted(((r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in got), key=key) == sorted(want, key=key)
    padded = 0
    for _, rows in itertools.groupby(sorted(got, key=lambda r: (r["sequence_id"], r["offset"])), key=lambda r: r["sequence_id"]):
        at = 0
        for r in rows:
            assert r["offset"] == at
            at += r["length"]
        assert at <= 2048
        padded += at if at & (at - 1) == 0 else 2048
    assert padded - sum(r["length"] for r in got) < 2048 * 2


def test_packing_looks_up_each_word_once(monkeypatch):
    """A batch of texts has the tokenizer's ids, and each of its different parts of words goes to the model once."""
    import pyarrow as pa

    encoder = packing.WordEncoder(tokenizer_path())
    odd = ["", None, " a  b ", "Hi<|endoftext|> there", "x\x85y z", "\x0bq\x0c", "Don't STOP'LL 12 İı ß éÉ 日本語 日本語", "\x1cfoo", "a\x00b", "ŉ ǅ ªº"]
    texts = odd + ["the same words, the SAME words. " * 50] * 20 + odd
    made = []
    monkeypatch.setattr(encoder, "_part", lambda p, make=encoder._part: made.append(p) or make(p))
    for _ in range(2):
        ids, ends = encoder.encode(pa.array(texts))
        for text, got in zip(texts, np.split(ids, ends[:-1]), strict=True):
            assert got.tolist() == encoder.tokenizer.encode(text or "", add_special_tokens=False).ids
    assert len(made) == len(set(made)) and {"the", "same", "words"} <= set(made)
    # Parts that the tables have no room for are found again.
    monkeypatch.setattr(packing, "WORDS_KEPT", 2)
    assert encoder.encode(pa.array(texts))[0].tolist() == ids.tolist()
    assert encoder.encode(pa.array([], pa.string()))[0].tolist() == []


def test_packing_plan_uses_every_piece():
    r = random.Random(3)
    histogram = {k: r.randint(1, 40) for k in r.sample(range(1, 2049), 600)}
    used = {}
    for tier, kind, times in packing.packing_plan(histogram):
        assert sum(k * n for k, n in kind) <= tier and (tier == 2048 or sum(k * n for k, n in kind) == tier)
        for k, n in kind:
            used[k] = used.get(k, 0) + n * times
    assert used == histogram


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _valid(kind, value):
    d = re.sub(r"\D", "", value)
    luhn = sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d))) % 10 == 0
    return {"email": True, "ip": kind != "ip" or all(int(p) <= 255 for p in value.split(".")), "card": 13 <= len(d) <= 19 and luhn, "phone": 9 <= len(d) <= 15}[kind]


def test_pii_base_spans_and_contexts(spark):
    odd = [
        "a@b.c_d@e.f x@y a@b@c.d. 1.2.3.4.5.6.7.8 300.1.1.1 0001.02.3.255 4111 1111 1111 1111 4111-1111-1111-1112",
        "+1 (017) 555-7713 +1+49 30 1234567 ñandú ü@ö.de ü a.b@c-d.e-f.gh 😀 4111111111111111 7",
        "9" * 30_000 + " " + "a" * 30_000, "", None, "4111 1111 1111 1111" * 60,
    ]
    odd += [f"reach her at p{i}@mail.org today" for i in range(8)] + ["you can reach her at usr-4471-k, or not", "serial 99887766 is a part number"]
    rows = [(i, t, "s") for i, t in enumerate(odd)] + [(None, "x@y.zz", "s"), (2, odd[2], "s")]
    docs = spark.createDataFrame(_rows(rows), DOCS)
    got = pii.find_entities(docs).withColumn("base", pii.span_list(list(pii.KINDS))).collect()
    assert len(got) == len(rows)
    want = {i: ",".join(f"{k}:{m.start()}:{m.end()}" for k, p in PATTERNS.items() for m in re.finditer(p, t or "", re.A) if _valid(k, m.group())) for i, t, _ in rows}
    assert {r["doc_id"]: r["base"] for r in got} == want
    assert {(r["doc_id"], x["value"]) for r in got for x in r["id"]} == {(14, "usr-4471-k")}
    clean = pii.redact(docs.where("doc_id IS NOT NULL AND doc_id > 5"))
    assert clean.dtypes == docs.dtypes
    texts = {r["doc_id"]: r["text"] for r in clean.collect()}
    assert texts[6] == "reach her at [EMAIL] today" and texts[14] == "you can reach her at [ID], or not" and texts[15] == odd[15]


def test_redact_cuts_each_row_at_its_own_spans(spark):
    rows = [(None, f"{'x' * i} mail p{i}@mail.org now", "s") for i in range(6)] + [(None, f"clean text number {i}", "s") for i in range(4)]
    rows += [(7, "call +49 30 1234567 today", "s"), (7, "nothing in here at all", "s"), (7, "or p@q.org", "s"), (8, "a p@q.org", "s"), (8, "a p@q.org", "s"), (None, None, "s")]
    want = [re.sub(r"\S+@\S+", "[EMAIL]", t).replace("+49 30 1234567", "[PHONE]") if t else None for _, t, _ in rows]
    docs = spark.createDataFrame(_rows(rows), DOCS)
    out = pii.redact(docs)
    assert out.dtypes == docs.dtypes
    key = lambda x: (x[0] or -1, x[1] or "")
    assert sorted(((r["doc_id"], r["text"]) for r in out.collect()), key=key) == sorted(((i, w) for (i, _, _), w in zip(rows, want)), key=key)


def _labelled():
    r, words, out, labels = random.Random(2), _vocabulary(300), [], []
    for i in range(160):
        t = r.choices(words, k=60)
        if i % 4 == 0:
            t[r.randrange(60)] = r.choice(["Idiot!", "scum", "SCUM", "moron,"])
            t[r.randrange(60)] = r.choice(["idiot", "scum", "moron"])
        out.append((i, " ".join(t), "s"))
        labels.append((i, int(i % 4 == 0)))
    return out, labels


def test_toxicity_finds_held_out_texts(spark):
    rows, labels = _labelled()
    extra = [(200, "", "s"), (201, None, "s"), (None, "you idiot, you scum", "s"), (202, "idiot scum " * 20_000, "s"), (5, rows[5][1], "s")]
    docs = spark.createDataFrame(_rows(rows + extra), DOCS)
    known = spark.createDataFrame(labels[:120] + [(0, 1), (None, 1), (3, None)], "doc_id long, label int")
    clashing = docs.withColumns({"v": F.lit(1), "_toxicity": F.lit("kept"), "score": F.lit("replaced")})
    scored = toxicity.score(clashing, known)
    assert scored.columns == [*docs.columns, "v", "_toxicity", "score", "predicted", "evidence"]
    got = scored.collect()
    assert {(r["v"], r["_toxicity"]) for r in got} == {(1, "kept")}
    assert len(got) == len(rows) + len(extra) and all(0 <= r["score"] <= 1 for r in got)
    held = {r["doc_id"]: r["predicted"] for r in got if r["doc_id"] is not None and 120 <= r["doc_id"] < 160}
    assert held == {i: y for i, y in labels[120:]}
    by_id = {r["doc_id"]: r for r in got}
    assert by_id[None]["predicted"] == 1 and by_id[202]["predicted"] == 1 and by_id[200]["score"] == by_id[201]["score"] < 0.3
    assert all(e["label"] == 1 for e in by_id[202]["evidence"])
    assert {r["predicted"] for r in toxicity.score(docs, known.where("false")).collect()} == {0}
    assert toxicity.score(docs.where("false"), known).count() == 0
    # A fitted model scores other documents as it scores those that it was fitted on.
    model, _ = toxicity.fit(docs, known, keep=["doc_id"])
    again = {r["doc_id"]: r["score"] for r in toxicity.score_with(docs, model).collect()}
    assert all(abs(again[r["doc_id"]] - r["score"]) < 1e-12 for r in got)
    # Fewer terms than the examples have together: a part of them, smallest hash first.
    few, _ = toxicity.fit(docs, known, max_postings=3000)
    assert 0 < len(few.ids) < len(model.ids)


def test_toxicity_of_other_documents_takes_one_worker_a_task(spark):
    rows, labels = _labelled()
    docs = spark.createDataFrame(_rows(rows + [(200, "", "s"), (201, None, "s")]), DOCS)
    model, stage = toxicity.fit(docs, spark.createDataFrame(labels[:120], "doc_id long, label int"))
    scored = toxicity.score_with(docs, model)
    assert scored._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1
    want = toxicity._scored(stage, model, toxicity.THRESHOLD)
    assert sorted(scored.collect(), key=str) == sorted(want.collect(), key=str)


def test_toxicity_searches_clean_examples_for_every_text(spark):
    """A toxic manner of few examples, whose words are too rare each to lean beyond chance, is found by its neighbours."""
    r, words = random.Random(6), _vocabulary(300)
    rows = [(i, " ".join(r.choices(words, k=40)), "s") for i in range(120)]
    manner = ["".join(r.choices("mnopqr", k=6)) for _ in range(60)]
    rows += [(i, " ".join(r.choices(manner, k=12) + r.choices(words, k=30)), "s") for i in range(120, 150)]
    labels = [(i, int(i >= 120)) for i in range(150)]
    docs = spark.createDataFrame(_rows(rows), DOCS)
    known = spark.createDataFrame([x for x in labels if x[0] % 3], "doc_id long, label int")
    model, _ = toxicity.fit(docs, known)
    assert len(model.ids) == 100 and sum(model.labels) == 20
    got = {x["doc_id"]: x for x in toxicity.score(docs, known).collect()}
    assert all(len(x["evidence"]) == toxicity.NEIGHBOURS for x in got.values())
    assert {i: got[i]["predicted"] for i, _ in labels if i % 3 == 0} == {i: y for i, y in labels if i % 3 == 0}


def test_block_max_index_is_exact():
    r = random.Random(4)
    vectors = []
    for _ in range(500):
        v = {t: r.random() for t in r.sample(range(40), r.randint(1, 6))}
        n = sum(x * x for x in v.values()) ** 0.5
        vectors.append({t: x / n for t, x in v.items()})
    vectors += vectors[:50]  # ties
    index = toxicity.BlockMaxIndex(vectors, list(range(len(vectors))), block=16)
    for q in vectors[:60]:
        cosines = [(sum(w * v.get(t, 0) for t, w in q.items()), -i) for i, v in enumerate(vectors)]
        best = [(round(c, 9), -i) for c, i in sorted(cosines, reverse=True)[:15] if c > 0]
        got = [(round(c, 9), i) for i, c in index.nearest(q, 15)]
        assert sorted(c for c, _ in got) == sorted(c for c, _ in best) and {i for c, i in got if c > best[-1][0]} == {i for c, i in best if c > best[-1][0]}


def test_block_max_index_skips_blocks_before_summing_them():
    """Examples in groups with words of their own: a query sums few blocks, also where the words are common in the examples."""
    r = random.Random(9)
    vectors = []
    for g in range(20):
        for _ in range(64):
            v = {100 * g + t: r.random() + 0.5 for t in r.sample(range(30), 12)} | {5000 + t: 0.1 for t in range(20)}
            n = sum(x * x for x in v.values()) ** 0.5
            vectors.append({t: x / n for t, x in v.items()})
    index = toxicity.BlockMaxIndex(vectors, list(range(len(vectors))))
    for q in range(0, len(vectors), 40):
        cosines = sorted((-sum(w * vectors[i].get(t, 0) for t, w in vectors[q].items()), i) for i in range(len(vectors)))[:15]
        assert [round(c, 9) for _, c in index.nearest(vectors[q], 15)] == [round(-c, 9) for c, _ in cosines]
    assert index.visited < 0.35 * index.asked


def test_terms_are_packed_and_unpacked():
    for terms, counts in (([], []), ([0, 5, 6, 400_000], [1, 2, 3, 70_000]), ([3], [1])):
        t, c = toxicity.unpack_terms(*toxicity.pack_terms(np.array(terms, dtype=np.int64), np.array(counts, dtype=np.int64)))
        assert t.tolist() == terms and c.tolist() == counts


def _vectors():
    r = np.random.default_rng(5)
    x = r.standard_normal((300, 16))
    x /= np.linalg.norm(x, axis=1)[:, None]
    for i in range(200, 260):
        x[i] = x[i % 7] + r.standard_normal(16) * 0.05
    rows = [(i, [float(np.float32(v)) for v in x[i]], i % 3) for i in range(300)]
    rows += [(400, rows[0][1], 1), (401, rows[0][1], 1), (402, None, 1), (403, [0.0] * 16, 1), (404, [1.0] * 15 + [float("nan")], 1), (405, [], 1)]
    rows += [(406, [1.0] * 15 + [None], 1), (407, [1.0] * 8, 1), (408, [2.0] * 8, 1), (None, rows[1][1], 1), (7, rows[7][1], 1), (409, [float("inf")] * 16, 1)]
    return rows


@pytest.mark.parametrize("block", [4096, 8])
def test_embedding_dedup_links(spark, block):
    rows = _vectors()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, n_links int")
    got = embedding_dedup.near_duplicates(df, recall=1.0, block=block).collect()
    good = {i: np.array(v, float) for i, v, _ in rows if i is not None and v and None not in v and np.isfinite(v).all() and any(v)}
    links = [
        (a, b) for a, b in itertools.combinations(good, 2)
        if len(good[a]) == len(good[b]) and good[a] @ good[b] / np.linalg.norm(good[a]) / np.linalg.norm(good[b]) >= 0.95
    ]
    low = _reach({r[0] for r in rows}, links)
    n = {i: sum(i in x for x in links) for i in low}
    assert len(got) == len(rows)
    assert {(r["vec_id"], r["n_links"], r["component_id"]) for r in got if r["vec_id"] is not None} == {(i, n[i], low[i]) for i in low if i is not None}
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got if r["vec_id"] is not None)
    most = embedding_dedup.near_duplicates(df).agg(F.sum("n_links")).first()[0]
    assert most >= 0.9 * sum(n.values())


def test_a_block_of_mutually_linked_vectors_takes_bounded_memory():
    """4,096 residents and 20,000 visitors that all link each other: counts and roots, without holding the pairs."""
    import tracemalloc

    import pyarrow as pa

    r = np.random.default_rng(1)
    n, kind = 20_000, "<f4"
    x = (np.ones(16) + 0.01 * r.standard_normal((n, 16))).astype(kind)
    names = ["cell", "block", "side", "id", "n", "v"]

    def batches():
        rows = [("c", 0, 0, i, 1, x[i].tobytes()) for i in range(4096)] + [("c", 0, 1 if i < 4096 else 2, i, 1, x[i].tobytes()) for i in range(n)]
        rows += [("d", 0, 0, n + 1, 2, x[0].tobytes()), ("e", 0, 1, n + 2, 2, x[0].tobytes())]
        for at in range(0, len(rows), 5000):
            yield pa.RecordBatch.from_pylist([dict(zip(names, row)) for row in rows[at : at + 5000]])

    tracemalloc.start()
    links, roots = {}, {}
    for b in embedding_dedup._links_in_cells(0.95, kind)(batches()):
        for i, k, root in zip(*(b[c].to_pylist() for c in ("id", "n_links", "root"))):
            links[i] = links.get(i, 0) + k
            roots.setdefault(i, set()).add(root)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 500e6
    # Residents see the others of the block and the visitors of other cells; those see the residents.
    assert all(links[i] == (n - 1 if i < 4096 else 4096) for i in range(n)) and links.get(n + 1, 0) == 0
    low = _reach(set(roots) | {0}, [(i, j) for i, js in roots.items() for j in js])
    assert {low[i] for i in range(n)} == {0} and n + 2 not in roots


def test_residents_joined_by_later_visitors_get_one_label():
    label = np.arange(6)
    for near in ([[1, 1, 0, 0, 0, 0]], [[0, 0, 1, 1, 0, 0]], [[0, 0, 0, 0, 0, 0]], [[0, 0, 0, 1, 1, 0], [0, 1, 0, 0, 1, 0]]):
        label = embedding_dedup._merge(label, np.array(near, dtype=bool))
    assert label.tolist() == [0, 0, 0, 0, 0, 5]


def test_multi_sequence_visits_cells_in_order():
    a, b = [(0.0, 3), (0.2, 1), (0.5, 2)], [(0.0, 9), (0.1, 8), (0.4, 7)]
    cost = {(i, j): x + y for x, i in a for y, j in b}
    cells = list(embedding_dedup.multi_sequence(a, b, 0.5))
    assert [cost[c] for c in cells] == sorted(cost[c] for c in cells) and set(cells) == {c for c, x in cost.items() if x <= 0.5}


def test_nearest_by_inner_product(spark, monkeypatch):
    monkeypatch.setattr(nearest, "SHARD", 100)
    monkeypatch.setattr(nearest, "QUERIES", 10)
    rows = _vectors()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score int")
    got = nearest.nearest_neighbours(df, df.where("vec_id % 20 = 0"), k=10).collect()
    good = {i: np.array(v, float) for i, v, _ in rows if i is not None and v and None not in v and np.isfinite(v).all() and any(v)}
    found = total = 0
    for q in (i for i in good if i % 20 == 0):
        own = sorted((r["rank"], r["vec_id"], r["score"]) for r in got if r["query_id"] == q)
        best = sorted((-(good[q] @ v), i) for i, v in good.items() if i != q and len(v) == len(good[q]))[:10]
        assert [r for r, _, _ in own] == list(range(1, len(best) + 1))
        assert all(abs(s - good[q] @ good[i]) < 1e-12 for _, i, s in own)
        found, total = found + len({i for _, i, _ in own} & {i for _, i in best}), total + len(best)
    assert found >= 0.9 * total
    assert nearest.nearest_neighbours(df.where("false"), df).count() == 0


def test_language_of_code_switched_words(spark):
    r = random.Random(6)
    parts = {"aa": "the nation with thing ough", "bb": "der keit ung schaft eine", "cc": "que cion los mente ado"}
    word = {k: [x + y for x in v.split() for y in v.split()] + v.split() for k, v in parts.items()}
    text = lambda k, n: " ".join(r.choices(word[k], k=n))
    rows = [(i, text(k, 40), k, "s", 0, 1, "x", 2) for i, k in enumerate(list(parts) * 20)]
    odd = [(100, None, "aa"), (101, "123 !?", "aa"), (102, text("bb", 20_000), None), (None, text("cc", 30), None), (103, "", None), (5, rows[5][1], rows[5][2])]
    docs = spark.createDataFrame(rows + [(i, t, k, "s", 0, 1, "x", 2) for i, t, k in odd], DOCS)
    tagger = language_id.fit(docs.where("doc_id < 45 OR doc_id > 99"))
    got = {r["doc_id"]: r for r in language_id.identify(docs, tagger).collect()}
    assert all(got[i]["lang_pred"] == rows[i][2] for i in range(60))
    assert got[102]["lang_pred"] == "bb" and got[None]["lang_pred"] == "cc" and 0 < got[102]["score"] <= 1
    assert all((got[i]["lang_pred"], got[i]["score"]) == ("und", 0.0) for i in (100, 101, 103))
    mixed = [(k, w) for k in ("aa", "cc", "bb") for w in r.choices(word[k], k=12)]
    labels = tagger.label_words(" ".join(w for _, w in mixed))
    assert np.mean([a == b for (a, _), (_, b, _) in zip(mixed, labels)]) > 0.9
    nothing = language_id.fit(docs.where("false"))
    assert {r["lang_pred"] for r in language_id.identify(docs, nothing).collect()} == {"und"}


def test_forward_backward_against_all_paths():
    r = np.random.default_rng(8)
    emit, move, begin = r.normal(size=(4, 2, 3)), r.normal(size=(3, 3)), r.normal(size=3)
    lengths = np.array([4, 2])
    post, moved = language_id.forward_backward(emit, lengths, move, begin)
    smooth = language_id._smooth(emit, lengths, move, begin)
    pairs = np.zeros((3, 3))
    for b, n in enumerate(lengths):
        want, total = np.zeros((n, 3)), 0.0
        own = np.zeros((3, 3))
        for path in itertools.product(range(3), repeat=int(n)):
            p = np.exp(begin[path[0]] + sum(emit[t, b, y] for t, y in enumerate(path)) + sum(move[x, y] for x, y in zip(path, path[1:])))
            total += p
            for t, y in enumerate(path):
                want[t, y] += p
            for x, y in zip(path, path[1:]):
                own[x, y] += p
        pairs += own / total
        assert np.allclose(post[:n, b], want / total) and np.allclose(smooth[:n, b], want / total)
    assert np.allclose(moved, pairs)


def test_warc_round_trip(spark, tmp_path):
    long = "<html>" + "é" * 600
    pages = [(1, "http://www.B.org/x y", long), (2, "http://a.org:80/p?q", long), (3, "https://u@a.org", long), (4, None, "short"), (5, "bad\r\nurl", "short")]
    pages += [(6, "http://a.org/", None), (7, "http://a.org/", ""), (8, "http://c.org/", "WARC/1.1\r\n\r\nContent-Length: 5\r\n\r\n" * 99), (3, "https://u@a.org", long)]
    pages += [(None, "http://n.org/", long), (9, "http://l.org/", "x" * 3_000_000)]
    df = spark.createDataFrame([(*p, "x") for p in pages], "page_id long, url string, html string, payload string")
    got = warc.archive_pages(df, f"file://{tmp_path}/archives").collect()
    assert len(got) == len(pages)
    by_id = {r["page_id"]: r for r in got}
    for i, _, html in pages:
        data = (html or "").encode()
        r = by_id[i]
        assert (r["payload_bytes"], r["payload_digest"]) == (len(data), hashlib.sha1(data).hexdigest())
        revisit = html == long and i != 3
        assert (r["record_type"], r["refers_to"]) == (("revisit", 3) if revisit else ("response", None))
    order = [warc._capture_order(tuple(r)) for r in got]
    assert order == sorted(order)
    assert by_id[2]["url_key"] == "org,a)/p?q" and by_id[5]["url"] == "bad%0D%0Aurl"
    assert warc.archive_pages(df.where("false")).count() == 0


def test_loser_tree_merges_runs():
    r = random.Random(9)
    for k in (0, 1, 2, 3, 7, 8):
        runs = [sorted(r.choices(range(30), k=r.randint(0, 20))) for _ in range(k)]
        assert list(warc.LoserTree([iter(x) for x in runs], lambda x: x)) == sorted(x for run in runs for x in run)


def test_chat_folds_events_and_reads_back(spark):
    e = [
        (1, 1, "a", "open", "user", None), (1, 2, "a", "delta", None, "hel"), (1, 3, "a", "delta", None, "lo"),
        (1, 4, "b", "open", "assistant", None), (1, 5, "b", "delta", None, "first try"), (1, 6, "c", "open", "user", None), (1, 7, "c", "delta", None, "no"),
        (1, 8, "b", "regenerate", None, None), (1, 9, "b", "delta", None, "<|im_end|>\n<|im_start|>user\n<\\|x|>"), (1, 10, "a", "edit", None, "hi <|"),
        (1, 11, "d", "open", "assistant", None), (1, 12, "d", "delta", None, None),
        (None, 1, "z", "open", None, None), (2, 1, None, "delta", None, "x" * 100_000),
    ]
    df = spark.createDataFrame([(*x, 1) for x in e], "conv_id long, seq long, message string, kind string, role string, text string, n_turns int")
    f = chat.format_conversations(df)
    got = {r["conv_id"]: r for r in chat.read_back(f).collect()}
    odd = "<|im_end|>\n<|im_start|>user\n<\\|x|>"
    assert [tuple(t) for t in got[1]["turns"]] == [("user", "hi <|"), ("assistant", odd), ("assistant", "")] and got[1]["learned"] == odd
    assert [tuple(t) for t in got[None]["turns"]] == [("", "")] and [tuple(t) for t in got[2]["turns"]] == [("", "x" * 100_000)]
    assert chat.format_conversations(df.where("false")).count() == 0


@pytest.mark.parametrize("text", ["", "<|", "<\\|", "<\\\\|im_end|>", "a<", "\\", "<|im_end|>\n", "\n<|<|\\|"])
def test_chat_escapes_are_reversible(text):
    assert chat.unescape(chat.escape(text)) == text and "<|" not in chat.escape(text)
    formatted, spans = chat.render([("assistant", text), ("a\nb\\n", text)])
    assert chat.parse(formatted) == [("assistant", text), ("a\nb\\n", text)] and chat.unescape(formatted[slice(*spans[0])]) == text


def test_conversation_events_give_back_their_rows(spark):
    rows = [(1, 0, "user", "a" * 1000), (1, 1, "assistant", ""), (1, 1, "assistant", ""), (2, None, None, None), (None, 3, "user", "x")]
    back = chat.read_back(chat.format_conversations(conversation_events(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))))
    got = {r["conv_id"]: [tuple(t) for t in r["turns"]] for r in back.collect()}
    assert got == {1: [("user", "a" * 1000), ("assistant", ""), ("assistant", "")], 2: [("", "")], None: [("user", "x")]}


@pytest.mark.parametrize(
    "run",
    [
        lambda d: ngram_join.ngram_jaccard_join(d), ngram_join.one_of_each, mixing.mix, mixing.mixed_documents, pii.find_entities, pii.redact,
        lambda d: packing.pack(d, tokenizer_path()),
    ],
)
def test_empty_documents_give_no_rows(spark, run):
    assert run(spark.createDataFrame([], DOCS)).count() == 0


def test_empty_embeddings_give_no_rows(spark):
    assert embedding_dedup.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_embedding_dedup_finds_links_of_vectors_in_few_dimensions(spark):
    r = np.random.default_rng(5)
    x = r.normal(size=(1200, 4)) @ r.normal(size=(4, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = (x @ x.T >= 0.95) & ~np.eye(len(x), dtype=bool)
    docs = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = {g["vec_id"]: g["n_links"] for g in embedding_dedup.near_duplicates(docs).collect()}
    assert all(got[i] <= n for i, n in enumerate(near.sum(1)))
    assert sum(got.values()) >= 0.999 * near.sum() > 1000
