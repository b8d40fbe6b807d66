"""Prefix trie, tokenizer alignment and token counts against brute-force versions, with the odd cases their docstrings define."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import pytest

from tabcast.llm import prefix_trie, token_counts, tokenizer_alignment
from tabcast.llm.queries import rebuilt_sequences, tokenizer_path

# ---------------------------------------------------------------- prefix trie

NODE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
CONVERSATIONS = "conv_id long, turn long, role string, text string, hs int, depth string"


def _rebuilt(rows):
    found = defaultdict(list)
    for i, turn, role, text, *_ in rows:
        if i is not None:
            md5 = [hashlib.md5((x or "").encode()).hexdigest() for x in (role, text)]
            found[i].append((turn is not None, turn or 0, *md5, role or "", text or ""))
    own = {i: [x[-2:] for x in sorted(v)] for i, v in found.items()}
    first = {i: zlib.crc32(str(i).encode()) % 6 for i in own}
    return {i: own.get(i - int(math.fmod(i, 100)), [])[: first[i]] + own[i][first[i] :] for i in own}


def _trie(sequences):
    nodes, children = defaultdict(list), defaultdict(set)
    for i, s in sequences.items():
        for d in range(len(s) + 1):
            nodes[tuple(s[:d])].append(i)
    for n in nodes:
        if n:
            children[n[:-1]].add(n)
    leaves, saved = {}, {}
    for n in sorted(nodes, key=len, reverse=True):
        leaves[n] = sum(leaves[k] for k in children[n]) or 1
        saved[n] = sum(saved[k] for k in children[n]) + (len(nodes[n]) - 1) * (len(n[-1][1]) if n else 0)
    out = []
    for n, m in nodes.items():
        ends = ",".join(str(i) for i in sorted(m) if len(sequences[i]) == len(n)).encode()
        above = min(nodes[n[:-1]]) if n else None
        out.append((min(m), len(n), above, len(m), len(children[n]), leaves[n], saved[n], hashlib.sha256(ends).hexdigest()))
    return out


def _order(row):
    return tuple((x is None, x) if not isinstance(x, str) else (False, x) for x in row)


def _got(df, columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=_order)


def test_two_fattest(spark):
    pairs = [(a, b) for a in range(0, 40) for b in range(a + 1, 41)]
    got = spark.createDataFrame(pairs, "l int, r int").withColumn("f", prefix_trie.two_fattest("l", "r")).collect()
    for r in got:
        assert r["f"] == max(range(r["l"] + 1, r["r"] + 1), key=lambda x: x & -x)


@pytest.mark.parametrize("long", [False, True])
def test_prefix_trie_is_exact(spark, long):
    """Batches of 30 and 300: the second is located by fat binary search; chains, copies, nulls and repeated rows."""
    r, rows = random.Random(5), []
    for i in range(160):
        for k in range(r.randint(1, 40) if long else r.choice([0, 1, 2, 3, 5, 9])):
            rows.append((i, k, "u", "x" if r.random() < 0.93 else "y") if long else (i, r.choice([None, k]), r.choice(["user", None]), r.choice(["a", "bé", None])))
    rows += [(None, 0, "u", "of no conversation"), (3, 1, "u", "x"), (3, 1, "u", "x"), (10**12, 0, "u", "x" * 100_000)]
    df = spark.createDataFrame([(*x, 1, "clash") for x in rows], CONVERSATIONS)
    got = prefix_trie.prefix_trie(rebuilt_sequences(prefix_trie.sequences(df)), first_batch=30, growth=10)
    assert _got(got, NODE) == sorted(_trie(_rebuilt(rows)), key=_order)


def test_prefix_trie_of_nothing_and_of_copies(spark):
    none = spark.createDataFrame([], CONVERSATIONS)
    assert prefix_trie.prefix_trie(prefix_trie.sequences(none)).collect() == []
    rows = [(i, k, "u", f"t{k}") for i in range(40) for k in range(3)]
    got = prefix_trie.prefix_trie(prefix_trie.sequences(spark.createDataFrame(rows, CONVERSATIONS.split(", hs")[0])), first_batch=4)
    assert _got(got, NODE) == sorted(_trie({i: [("u", f"t{k}") for k in range(3)] for i in range(40)}), key=_order)
    turnless = spark.createDataFrame([(7, []), (9, [])], "conv_id long, turns array<struct<digest:binary,chars:int>>")
    assert _got(prefix_trie.prefix_trie(turnless), NODE) == [(7, 0, None, 2, 0, 1, 0, hashlib.sha256(b"7,9").hexdigest())]


# ---------------------------------------------------------------- tokenizer alignment

ALIGNED = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def _groups_by_cuts(a_ends, b_ends):
    groups, i, j = [], 0, 0
    for cut in sorted(set(a_ends) & set(b_ends)):
        k, m = a_ends.index(cut) + 1, b_ends.index(cut) + 1
        groups.append((i, k, j, m))
        i, j = k, m
    return groups


def test_align_equals_a_scan_over_all_cuts():
    r = random.Random(1)
    for _ in range(2000):
        end = r.randint(1, 60)
        a, b = (sorted({*r.sample(range(1, end + 1), r.randint(0, end)), end}) for _ in range(2))
        assert tokenizer_alignment.align(a, b) == _groups_by_cuts(a, b)
    assert tokenizer_alignment.align([], []) == []
    # Cuts at both far ends only: every end is looked up once, so this takes no time.
    n = 200_000
    a, b = [*range(1, 500), *range(1000, 2 * n, 2), *range(2 * n, 2 * n + 500)], [*range(1, 500), *range(1001, 2 * n, 2), *range(2 * n, 2 * n + 500)]
    assert len(tokenizer_alignment.align(a, b)) == 499 + 500


@pytest.fixture(scope="module")
def tokenizers():
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=tokenizer_path("piece_bpe_32k.model"))


def _aligned(rows, a, b):
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(256, 512))
    byte = {(chr(x) if x in plain else chr(next(rest))): x for x in range(256)}
    docs, counts = [], Counter()
    for i, text, *_ in rows:
        e, ids = a.encode(" " + (text or ""), add_special_tokens=False), b.encode(text or "")
        spelt = [bytes(byte[c] for c in t) for t in e.tokens]
        pieces = [bytes([int(p[3:5], 16)]) if b.is_byte(x) else p.replace("▁", " ").encode() for x, p in zip(ids, map(b.id_to_piece, ids))]
        if not text or not b"".join(spelt) == b"".join(pieces) == (" " + text).encode():
            docs.append((i, [], [], [], []))
            continue
        ends = [[sum(map(len, x[: k + 1])) for k in range(len(x))] for x in (spelt, pieces)]
        groups = [(e.ids[p:q], ids[s:t]) for p, q, s, t in _groups_by_cuts(*ends)]
        links = [(x, y) for xs, ys in groups for x in xs for y in ys]
        counts.update(set(links))
        docs.append((i, e.ids, ids, groups, links))
    best = defaultdict(int)
    for (x, _), n in counts.items():
        best[x] = max(best[x], n)
    out = []
    for i, xs, ys, groups, links in docs:
        text = ";".join(f"{','.join(map(str, p))}|{','.join(map(str, q))}" for p, q in groups)
        sums = sum(counts[p] == best[p[0]] for p in links), sum(counts[p] for p in links)
        out.append((i, len(xs), len(ys), len(groups), len(links), *sums, hashlib.sha256(text.encode()).hexdigest() if xs else ""))
    return out


PARTS = ["a", "b", ",", ". ", "; ", "é,", "'t", "...", " ", "  ", "\n", "\t", " \n ", "é", "ß", "漢", "\x1c", " ", "　", "'s", "12", "!", "<|endoftext|>", "<s>", "<0x41>", "▁", "\x00", "🙂", "՘", "the ", " and", "᠎", " "]


def _odd_texts(n):
    r = random.Random(3)
    texts = [(i, "".join(r.choices(PARTS, k=r.randint(0, 25)))) for i in range(n)]
    return [*texts, (None, "x y"), (5, None), (6, ""), (7, " "), (8, "a "), (9, "  "), (10, "a" * 3000), (11, "a b the " * 300), (11, "a b the " * 300)]


def test_alignment_equals_brute_force(spark, tokenizers, monkeypatch):
    paths = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")
    rows = [(i, t, "x", 1) for i, t in _odd_texts(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string, block string, n int").repartition(3)
    want = sorted(_aligned(rows, *tokenizers), key=_order)
    assert _got(tokenizer_alignment.align_documents(df, *paths), ALIGNED) == want
    assert sum(w[1] == 0 for w in want) > 2
    assert tokenizer_alignment.align_documents(df.limit(0), *paths).collect() == []


def test_long_groups_are_counted_not_listed():
    pairs, links = tokenizer_alignment.links_of([5] * 30_000, [7] * 29_999 + [8])
    assert dict(zip(pairs, links)) == {(5 << 32) + 7: 30_000 * 29_999, (5 << 32) + 8: 30_000}


# ---------------------------------------------------------------- token counts


def test_token_counts_are_the_library_s(spark, monkeypatch):
    from tokenizers import Tokenizer

    path = tokenizer_path("byte_bpe_50k.json")
    tokenizer = Tokenizer.from_file(path)
    rows = [(i, t, "kept", 1) for i, t in [*_odd_texts(400), (12, "word " * 50_000), (13, "ab" * 20_000)]]
    df = spark.createDataFrame(rows, "doc_id long, text string, row string, n_bytes int")
    got = token_counts.count_tokens(df, path, limit=100)
    assert {*got.columns} == {"doc_id", "text", "row", "n_bytes", "n_tokens", "over_limit"}
    want = []
    for i, t, *_ in rows:
        n = len(tokenizer.encode(t or "", add_special_tokens=False))
        want.append((i, len((t or "").encode()), n, n > 100))
    assert _got(got, ["doc_id", "n_bytes", "n_tokens", "over_limit"]) == sorted(want, key=_order)
    assert token_counts.count_tokens(df.limit(0), path).collect() == []


def test_token_counts_do_not_depend_on_the_tables():
    path = tokenizer_path("byte_bpe_50k.json")
    texts = [t or "" for _, t in _odd_texts(300)]
    plain, wide = token_counts.Lengths(path, {}), token_counts.Lengths(path, {" and": 1, "a": 1})
    assert [plain.count(t) for t in texts] == [wide.count(t) for t in texts]
    with pytest.raises(ValueError):
        token_counts.PreTokens(tokenizer_path("word_bpe_49k.json"))
