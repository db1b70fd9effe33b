"""Operators with exact results against brute force: repeats, Jaccard classes, encoding, sharding, fingerprints, chats."""

import collections
import hashlib
import random
import re
import struct

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from changeflow.llm import bpe, chat, components, fingerprints, jaccard_join, sharding, suffix_array, suffix_dedup, words

EDGES = [(None, None), (1, None), (2, ""), (3, " \n\t "), (4, "one"), (4, "one"), (5, "two words"), (6, "é" * 300), (7, "a" * 5000), (8, "a" * 5000)]


def even_odd(n, a, b):
    """A text and its mirror image that sums of letters times powers modulo 2**64 can't tell apart, from n = 1024 on."""
    bits = [bin(i).count("1") % 2 for i in range(n)]
    return "".join((a, b)[x] for x in bits), "".join((b, a)[x] for x in bits)


# words


def test_words_and_their_hashes():
    r = random.Random(1)
    texts = ["".join(r.choice("aBb é\n") for _ in range(r.randint(0, 40))) for _ in range(500)] + ["", "x" * 1000 + " " + "y" * 64 + " " + "z" * 65 + " " + "z" * 4097]
    texts += [t for n in (16, 64, 128, 1024, 4096, 16384) for t in even_odd(n, "a", "b")]
    known = {}
    import pyarrow as pa

    for _, rows, raw, at in words.blocks(pa.array(texts), 5000):
        hashes, starts, ends, first = words.words(raw, at)
        for i in range(rows):
            want = [w.lower() for w in re.findall(rb"[^\x20\x09-\x0D]+", bytes(raw[at[i] : at[i + 1]]))]
            own = slice(first[i], first[i + 1])
            assert [bytes(raw[a:b]).lower() for a, b in zip(starts[own], ends[own], strict=True)] == want
            assert all(known.setdefault(w, h) == h for w, h in zip(want, hashes[own].tolist(), strict=True))
    assert len(set(known.values())) == len(known) > 300


# suffix arrays and repeats


def test_suffix_arrays():
    r = random.Random(3)
    for _ in range(400):
        k = r.choice([1, 2, 3, 200])
        s = np.asarray([r.randrange(k) for _ in range(r.randint(0, 50))], np.uint8)
        want = sorted(range(len(s)), key=lambda i: bytes(s[i:]))
        assert suffix_array.suffix_array(s).tolist() == want
        assert suffix_array.by_doubling(s.astype(np.int64)).tolist() == want


def brute_repeats(texts, length):
    count = collections.Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - length + 1):
            if count[t[i : i + length]] > 1:
                gone[i : i + length] = True
        kept = bytes(np.frombuffer(t, np.uint8)[~gone])
        out.append((len(t), int(gone.sum()), int((np.diff(gone.astype(int), prepend=0) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return out


def repeat_rows(prose):
    shared = prose(99, 60)
    rows = [(10 + i, prose(i, 40) + " " + shared + " " + prose(100 + i, 30)) for i in range(8)]
    rows += [(30, rows[0][1]), (31, rows[1][1][5:]), (32, shared[: len(shared) // 2] + shared + shared), (33, shared[3:150]), (33, prose(7, 90))]
    return rows + EDGES


@pytest.mark.parametrize("crowd", [1, 4000])
def test_repeats(spark, make, prose, crowd, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "CROWD", crowd)
    monkeypatch.setattr(suffix_dedup, "BLOCK", 1 << 10)  # long texts go through in several blocks
    rows = repeat_rows(prose) + [(70 + i, prose(200 + i, 2 * i) + prose(300, 200)) for i in range(4)]
    want = brute_repeats([(t or "").encode() for _, t in rows], 200)
    got = suffix_dedup.remove_repeats(spark, make(rows), 200).collect()
    assert sorted(tuple(r) for r in got if r[0] is not None) == sorted((i, *w) for (i, _), w in zip(rows, want, strict=True) if i is not None)
    assert len(got) == len(rows)


def test_repeats_of_texts_that_weak_hashes_mix_up(spark, make, prose):
    one, other = even_odd(2048, "a", "b")
    rows = [(1, prose(1, 30) + one + prose(2, 30)), (2, prose(3, 30) + other + prose(4, 30)), (3, one[:1500]), (4, "".join(chr(97 + (x == "a")) for x in one[:400]))]
    want = brute_repeats([t.encode() for _, t in rows], 200)
    got = {r[0]: tuple(r)[1:] for r in suffix_dedup.remove_repeats(spark, make(rows), 200).collect()}
    assert got == {i: w for (i, _), w in zip(rows, want, strict=True)}


def test_repeats_inside_one_window(spark, make, prose):
    """Strings that begin twice in a short stretch of one text, and nowhere else."""
    rows = [(p, prose(p, 20) + (prose(500 + p, p)[:p] * 400)[: 200 + p + extra] + prose(50 + p, 20)) for p in (1, 2, 7, 8, 30, 90, 136) for extra in (0, 1, 20)]
    rows += [(200, prose(60, 9) + "\0" * 201), (201, "é" * 150), (202, "z" * 200)]
    want = brute_repeats([t.encode() for _, t in rows], 200)
    got = suffix_dedup.remove_repeats(spark, make(rows), 200).collect()
    assert sorted(map(tuple, got)) == sorted((i, *w) for (i, _), w in zip(rows, want, strict=True))
    assert sum(w[1] > 0 for w in want) == len(rows) - 1


def test_prints_of_other_bases():
    raw = np.frombuffer(b"other bases", np.uint8)
    got = suffix_dedup.Prints(raw, (3, 5)).of(np.asarray([2]), np.asarray([9]))
    assert [int(x[0]) for x in got] == [sum((int(raw[i]) + 1) * b ** (i - 2) for i in range(2, 9)) % ((1 << 61) - 1) ^ 7 << 48 for b in (3, 5)]


def test_prints_are_the_polynomials_they_say():
    r = random.Random(2)
    raw, prime = np.asarray([r.randrange(256) for _ in range(3000)], np.uint8), (1 << 61) - 1
    begin, end = np.asarray([0, 5, 2600, 2999]), np.asarray([400, 5, 2937, 3000])
    inner = suffix_dedup.Prints(raw[2500:2950]).of(np.asarray([100]), np.asarray([437]))  # the same wherever the block begins
    assert [int(x[0]) for x in inner] == [int(x[2]) for x in suffix_dedup.Prints(raw).of(begin, end)]
    for base, got in zip(suffix_dedup.PRINT_BASES, suffix_dedup.Prints(raw).of(begin, end), strict=True):
        for a, b, h in zip(begin.tolist(), end.tolist(), got.tolist(), strict=True):
            value = sum((int(raw[i]) + 1) * pow(base, i - a, prime) for i in range(a, b)) % prime
            assert h % 2**64 == value ^ ((b - a) << 48) % 2**64


@pytest.mark.parametrize("text", [b"a" * 50_000, b"ab cd efg " * 5_000])
def test_few_windows_of_monotonous_texts(text):
    raw = np.frombuffer(text, np.uint8)
    doc, begin, count, *_ = suffix_dedup.runs(raw, np.asarray([0, len(raw)]), 200)
    assert len(doc) < len(raw) / 100 and count.sum() == len(raw) - 199 and (np.diff(begin) == count[:-1]).all()


def test_repeats_of_nothing(spark, make):
    assert suffix_dedup.remove_repeats(spark, make([]), 200).count() == 0
    assert suffix_dedup.remove_repeats(spark, make([(1, "short")]), 200).first()["n_removed"] == 0


# Jaccard classes


def brute_classes(rows, k, percent):
    sets = []
    for _, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set())
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None and sets[i]:
            least[find(i)] = min(doc, least.get(find(i), doc))
    return [(doc, len(s), least.get(find(i)) if s else doc) for i, ((doc, _), s) in enumerate(zip(rows, sets, strict=True))]


def family(r, base, n, edits):
    out = []
    for _ in range(n):
        w = base.split()
        for _ in range(r.randint(0, edits)):
            w[r.randrange(len(w))] = f"e{r.randrange(10**6)}"
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize("percent,k", [(85, 4), (80, 5), (100, 4)])
def test_classes(spark, make, prose, percent, k):
    r = random.Random(percent)
    passage = prose(1000, 40)
    texts = [t for s in range(3) for t in family(r, prose(s, 120), 25, 5)] + [prose(50 + s, r.randint(5, 100)) + " " + passage for s in range(25)]
    texts += [t.upper() if i % 2 else t for i, t in enumerate(family(r, prose(77, 12), 12, 2))] + [" ".join(["x"] * n) for n in (3, 4, 5, 50)]
    rows = [(100 + i, t) for i, t in enumerate(texts)] + EDGES + [(9, texts[0])]
    got = jaccard_join.jaccard_classes(spark, make(rows), k, percent).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, brute_classes(rows, k, percent)))


def test_classes_of_texts_that_weak_hashes_mix_up(spark, make):
    one, other = even_odd(1024, "a", "b")
    rows = [(1, one), (2, other), (3, one.upper()), (4, f"x {one} y z"), (5, f"x {other} y z")]
    got = jaccard_join.jaccard_classes(spark, make(rows), 4, 85).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, got)) == [(1, 1, 1), (2, 1, 2), (3, 1, 1), (4, 1, 4), (5, 1, 5)]


def test_one_of_each_class_stays(spark, make, prose):
    r = random.Random(5)
    rows = [(50 - i, t) for i, t in enumerate(family(r, prose(1, 150), 10, 2))] + [(60, prose(2)), (None, prose(3)), (61, ""), (62, ""), (63, "same row here it is now"), (63, "same row here it is now")]
    docs = make(rows)
    kept = jaccard_join.keep_one(spark, docs)
    assert kept.columns == docs.columns
    assert sorted(str(x["doc_id"]) for x in kept.collect()) == sorted(map(str, [41, 60, None, 61, 62, 63]))
    assert jaccard_join.jaccard_classes(spark, make([])).count() == 0


def test_one_of_each_class_stays_for_shared_and_null_ids(spark, make, prose):
    a, b, c = (prose(i, 150) for i in (900, 901, 902))
    near = lambda t: t + " end"
    rows = [(1, a), (2, near(a)), (2, b), (3, c), (3, near(c)), (4, c), (None, prose(903)), (None, prose(904, 150)), (None, near(prose(904, 150))), (None, near(near(a))), (None, ""), (None, ""), (5, None), (5, None)]
    rows += [(None, prose(905)), (None, prose(905))]
    docs = make(rows)
    # the last two differ in another column only: no text tells them apart, still one stays
    docs = docs.unionByName(docs.filter("doc_id = 4").selectExpr("4l as doc_id", "'other words that are here only once or twice' as text", *docs.columns[2:]))
    docs = docs.unionByName(docs.filter("doc_id = 4 and text like 'other%'").withColumn("lang", F.lit("en")))
    kept = [(x["doc_id"], x["text"]) for x in jaccard_join.keep_one(spark, docs).collect()]
    got = collections.Counter(kept)
    assert got[1, a] == got[2, b] == got[None, prose(903)] == got[None, prose(905)] == got[4, "other words that are here only once or twice"] == 1
    assert got[3, c] + got[3, near(c)] == 1 and got[None, prose(904, 150)] + got[None, near(prose(904, 150))] == 1
    assert got[None, ""] == got[5, None] == 2 and len(kept) == 11


def test_components(spark):
    r = random.Random(1)
    edges = [(i, i + 1) for i in range(0, 60)] + [(r.randrange(100, 200), r.randrange(100, 200)) for _ in range(70)] + [(300, 300 + i) for i in range(50)]
    root = {}
    for a, b in edges:
        for x in (a, b):
            root.setdefault(x, x)
    for _ in range(200):
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    got = {x["node"]: x["root"] for x in components.components(spark, spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {k: v for k, v in root.items() if any(a != b for a, b in edges if k in (a, b))}


# encoding


@pytest.fixture(scope="module")
def ranks():
    return bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))


@pytest.mark.parametrize("settle", [1 << 10, 64])
def test_encoding_is_the_published_one(ranks, settle):
    known = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    mine = bpe.Codec(ranks, public_tokenizers.PATTERN, keep_words=50)
    mine.machine.settle_at = settle
    r = random.Random(4)
    texts = ["", " ", "a" * 3000, "日本" * 500, "<|endoftext|>", "x" * 999 + "é", "=-" * 700, "".join(r.choice("abcdething") for _ in range(4000))]
    texts += ["".join(r.choice(r.choice(["ab", "the in gre.\n ", "日本éü🎉 x̀", "0123 9", "!?#%&*\n\t "])) for _ in range(r.randint(0, 50))) for _ in range(400)]
    for t in texts:
        ids = known.encode_ordinary(t)
        assert mine.encode(t) == struct.pack(f"<{len(ids)}I", *ids)
        assert "".join(mine.decode(mine.encode(t), 3)) == t


def test_decoder_of_broken_bytes():
    r = random.Random(2)
    for _ in range(500):
        data = bytes(r.choice([0x41, 0x80, 0xC3, 0xA9, 0xE2, 0x82, 0xAC, 0xF0, 0x9F, 0x8E, 0x89, 0xFF, 0xED, 0xA0]) for _ in range(12))
        utf8 = bpe.Utf8()
        cut = r.randrange(13)
        assert utf8.feed(data[:cut]) + utf8.feed(data[cut:]) + utf8.end() == data.decode(errors="replace")


def test_encoded_documents(spark, make, ranks):
    got = bpe.encode_documents(spark, make(EDGES), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN).collect()
    known = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = []
    for doc, t in EDGES:
        ids = known.encode_ordinary(t or "")
        want.append((doc, len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
    assert bpe.encode_documents(spark, make([]), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN).count() == 0


# sharding


@pytest.mark.parametrize("n", [0, 1, 2, 7, 100, 1009])
def test_permutation(n):
    plan = sharding.plan_feistel(n)
    assert plan.a * plan.b >= n and plan.walk < max(plan.a, 1)


@pytest.mark.parametrize("n", [0, 1, 5, 257])
def test_shards(spark, make, n):
    rows = [(i * 3, f"text {i % 11}") for i in range(n)] + (EDGES if n == 257 else [])
    got = sharding.shard_documents(spark, make(rows)).collect()
    by = collections.defaultdict(list)
    for r in got:
        by[r["shard"]].append(r["slot"])
    assert len(got) == len(rows) and all(sorted(s) == list(range(len(s))) for s in by.values())
    sizes = [len(by[s]) for s in range(8)]
    assert max(sizes) - min(sizes) <= 1
    import zlib

    assert sorted(str((r["doc_id"], r["size"], r["text_crc32"])) for r in got) == sorted(str((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode()))) for i, t in rows)
    again = sharding.shard_documents(spark, make(rows[::-1])).select("doc_id", "size", "shard", "slot").collect()
    assert sorted(map(str, again)) == sorted(map(str, [r.__class__(doc_id=r["doc_id"], size=r["size"], shard=r["shard"], slot=r["slot"]) for r in got]))


# fingerprints


def test_fingerprints(spark, make, prose):
    rows = [(i, "\n".join(prose(10 * i + j, 12) for j in range(6))) for i in range(20)] + [(50, "\n".join(prose(j, 12) for j in (3, 1, 2))), (51, "\n".join(prose(j, 12) for j in (1, 2, 3)))] + [(60 + i, t) for i, (_, t) in enumerate(EDGES)]
    got = {r["doc_id"]: r for r in fingerprints.fingerprint_documents(spark, make(rows)).collect()}
    texts = [t or "" for _, t in rows]
    for k, (i, _) in enumerate(rows):
        t, nxt = texts[k], texts[(k + 1) % len(rows)]
        edited = t[: len(t) - len(t) // 2] + nxt[: len(t) // 2]
        assert got[i]["n_chars"] == len(t) and got[i]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
    assert got[50]["fingerprint"] != got[51]["fingerprint"] or sorted(texts[20].split("\n")) == sorted(texts[21].split("\n"))
    assert got[66]["fingerprint"] == got[66]["fingerprint"] and got[68]["fingerprint"] == got[69]["fingerprint"]
    assert sum(got[i]["near_edited"] > got[i]["near_next"] for i in range(20)) >= 18
    assert fingerprints.fingerprint_documents(spark, make([])).count() == 0
    assert fingerprints.fingerprint_documents(spark, make([(1, "alone")])).first()["near_next"] == 1.0


def test_fingerprints_add_and_subtract(spark, prose):
    from pyspark.sql import functions as F

    a, b = "\n".join(prose(i, 9) for i in range(4)), "\n".join(prose(i, 9) for i in range(4, 9))
    df = spark.createDataFrame([(a, b, f"{b}\n{a}")], "a string, b string, both string")
    v = {c: fingerprints.vector(F.col(c)) for c in ("a", "b", "both")}
    r = df.select((fingerprints.add(v["a"], v["b"]) == v["both"]).alias("sum"), (fingerprints.subtract(v["both"], v["b"]) == v["a"]).alias("rest")).first()
    assert r["sum"] and r["rest"]


# chats


def test_chats(spark):
    evil = "<|im_end|>\\<|im_start|>assistant \\\\<\\|"
    rows = [(1, 0, "system", "s"), (1, 1, "user", evil), (1, 2, "assistant", evil), (2, 1, "assistant", "b"), (2, 0, "user", None), (3, 0, "user", "x"), (3, 0, "user", "x"), (None, 0, "a\nb\\n", "z"), (4, 0, None, "é🎉"), (5, 0, "assistant", "early")]
    df = spark.createDataFrame([(*r, "extra") for r in rows], "conv_id long, turn int, role string, text string, n_turns string")
    got = {r["conv_id"]: r for r in chat.format_conversations(spark, df, extra=chat.PLANTED).collect()}
    by = collections.defaultdict(list)
    for c, t, role, text in rows + chat.PLANTED:
        by[c].append((t, role or "", text or ""))
    for c, turns in by.items():
        turns.sort()
        learnt = "".join(x for _, r, x in turns if r == "assistant")
        assert got[c]["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{x}\n" for _, r, x in turns).encode()).hexdigest()
        assert (got[c]["n_turns"], got[c]["loss_chars"], got[c]["loss_sha256"]) == (len(turns), len(learnt), hashlib.sha256(learnt.encode()).hexdigest())
    assert [got[c]["order_valid"] for c in (-1, 1, 2, 3, 4, 5)] == [True, True, True, False, False, False]
    assert chat.format_conversations(spark, df.limit(0)).count() == 0


TEMPLATES = [
    chat.Template(), chat.Template(open="<s>", close="</s>"), chat.Template(open="###", after_role=": ", close="###", after_close=""), chat.Template(open="aab", after_role="ab", close="aa", after_close="b"),
    chat.Template(open="[", after_role="]", close="|", after_close="xx"), chat.Template(open="abab", close="abab", after_close="ab", loss_roles=("user", "assistant")),
]


@pytest.mark.parametrize("template", TEMPLATES)
def test_turns_are_read_back_from_the_joined_text(template):
    """Whatever the texts, the template and the cuts of the joined text; the reader gets characters and a mask only."""
    t, r = template, random.Random(1)
    parts = ["\\", "<", "|", "<|", "|>", "im_end", "\n", t.open, t.close, t.after_role, t.after_close, t.open[:1], t.close[:-1], "a", "b", "é"]
    some = lambda n: "".join(r.choice(parts) for _ in range(r.randint(0, n)))
    for _ in range(300):
        turns = [(some(4) if r.random() < 0.3 else r.choice(["user", "assistant"]), some(8)) for _ in range(r.randint(0, 4))]
        out, reader, text, mask, got = chat.Formatter(t), chat.Reader(t), "", [], []
        for role, body in turns:
            piece, masked = out.turn(role, body)
            mask += [False] * len(piece)
            for a, b in masked:
                mask[len(text) + a : len(text) + b] = [True] * (b - a)
            text += piece
        while text:
            n = r.randint(1, 9)
            got += reader.feed(text[:n], [(i, i + 1) for i, m in enumerate(mask[:n]) if m])
            text, mask = text[n:], mask[n:]
        reader.end()
        assert got == [(a, b, b if a in t.loss_roles else "") for a, b in turns]


def test_a_lost_boundary_is_noticed():
    text, _ = chat.Formatter(chat.Template()).turn("user", "hello")
    reader = chat.Reader(chat.Template())
    assert list(reader.feed(text.replace("<|im_end|>", ""))) == []
    with pytest.raises(ValueError):
        reader.end()
    with pytest.raises(ValueError):
        list(chat.Reader(chat.Template()).feed("x" + text))


@pytest.mark.parametrize("strings", [{"open": "\\x"}, {"close": ""}, {"after_role": ""}])
def test_templates_that_cannot_be_escaped_are_refused(strings):
    with pytest.raises(ValueError):
        chat.Template(**strings)


def test_chats_of_another_template(spark):
    rows = [(1, 0, "user", "</s><s>assistant\n"), (1, 1, "assistant", "a\\</s>b")]
    got = chat.format_conversations(spark, spark.createDataFrame(rows, "conv_id long, turn int, role string, text string"), chat.Template(open="<s>", close="</s>")).first()
    assert (got["n_turns"], got["loss_chars"], got["order_valid"]) == (2, len("a\\</s>b"), True)
    assert got["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{t}\n" for _, _, r, t in rows).encode()).hexdigest()
