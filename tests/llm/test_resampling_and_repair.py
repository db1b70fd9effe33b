"""Importance resampling, near copies by MinHash and conversation repair against brute force."""

import collections
import functools
import hashlib
import itertools
import math
import random
import re
import zlib

import duckdb
import numpy as np
import pytest

from changeflow.llm import chat_repair, importance, jaccard_join, minhash_dedup
from changeflow.llm.words import U

EDGES = [(None, None), (1, None), (2, ""), (3, " \n\t "), (4, "one"), (4, "one"), (5, "two words"), (6, "é" * 300), (7, "A-b " * 3000), (8, "A-b " * 3000), (9, "?!")]


# importance resampling


def features(text, longest):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return words, [" ".join(words[i : i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]


def brute_resample(docs, target, percent, buckets, longest, least):
    place = lambda f: zlib.crc32(f.encode()) % buckets
    s, t = (collections.Counter(place(f) for x in texts for f in features(x, longest)[1]) for texts in ([d[1] for d in docs], target))
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (s.total() + buckets) / ((s[b] + 1) * (t.total() + buckets))))
    rows = []
    for i, text in docs:
        words, found = features(text, longest)
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain(place(f)) for f in found)
        rows.append([i, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(words) >= least])
    able = sorted((r for r in rows if r[5]), key=lambda r: (-r[3], r[0] is None, r[0]))
    for rank, r in enumerate(able[: percent * len(able) // 100], 1):
        r[4] = rank
    return sorted((tuple(r[:5]) for r in rows), key=repr)


@pytest.mark.parametrize("longest", [1, 3])
def test_resampling(spark, make, prose, longest):
    docs = [*EDGES, *((20 + i, prose(i % 40, 15 + i % 30)) for i in range(120)), (20, prose(3, 40)), (None, prose(5, 40))]
    target = [prose(3, 50), None, "", prose(77, 20)]
    got = importance.resample(spark, make(docs), spark.createDataFrame([(t, 1) for t in target], "text string, score int"), percent=30, buckets=500, longest=longest, least_words=20)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute_resample(docs, target, 30, 500, longest, 20)


def test_resampling_of_nothing(spark, make):
    none = spark.createDataFrame([], "text string")
    assert importance.resample(spark, make([]), none).count() == 0
    assert [tuple(r) for r in importance.resample(spark, make([(1, "a b")]), none, buckets=10).select("n_features", "rank").collect()] == [(2, None)]


@pytest.mark.parametrize("longest", [1, 2, 4])
def test_tries_that_fill_up_and_texts_in_pieces(monkeypatch, longest):
    r = random.Random(longest)
    texts = ["".join(r.choice("abé .") for _ in range(r.randint(0, 300))) for _ in range(60)] + ["x" * 100 + " y", ""]
    gains = np.arange(97) - 40
    want = [(len(f), len(w), sum(int(gains[zlib.crc32(x.encode()) % 97]) for x in f)) for w, f in (features(t, longest) for t in texts)]
    total = collections.Counter(zlib.crc32(x.encode()) % 97 for t in texts for x in features(t, longest)[1])
    monkeypatch.setattr(importance, "NODES", 30)
    monkeypatch.setattr(importance, "PIECE", 16)
    trie = importance.Trie(97, longest, gains)
    assert [trie.weigh(t.encode()) for t in texts] == want
    trie = importance.Trie(97, longest)
    for t in texts:
        trie.count(t.encode())
    trie.settle()
    assert {i: n for i, n in enumerate(trie.totals.tolist()) if n} == dict(total)


# near copies by MinHash


def shingles(text, k):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)} if len(words) >= k else {tuple(words)} if words else set()


def brute_classes(docs, k, percent):
    found = [shingles(t, k) for _, t in docs]
    root = list(range(len(docs)))
    for i, j in itertools.combinations(range(len(docs)), 2):
        if found[i] and found[j] and 100 * len(found[i] & found[j]) >= percent * len(found[i] | found[j]):
            a, b = (next(x for x in iter_roots(root, y)) for y in (i, j))
            root[max(a, b)] = min(a, b)
    least = {}
    for i, (doc_id, _) in enumerate(docs):
        r = next(iter_roots(root, i))
        least.setdefault(r, []).append(doc_id)
    out = []
    for i, (doc_id, _) in enumerate(docs):
        ids = [x for x in least[next(iter_roots(root, i))] if x is not None]
        component = min(ids) if ids else None
        out.append((doc_id, len(found[i]), component, doc_id == component))
    return sorted(out, key=repr)


def iter_roots(root, i):
    while root[i] != i:
        i = root[i]
    yield i


def families(prose):
    rows = [(100 + i, prose(i, 60)) for i in range(30)]
    rows += [(200 + i, " ".join(prose(500, 400).split()[3 * i : 3 * i + 70])) for i in range(80)]  # a chain: only neighbours link
    common = prose(900, 40)
    rows += [(300 + i, common + " " + prose(1000 + i, 12 + i % 9)) for i in range(60)]  # near the threshold of each other
    r = random.Random(5)
    words = prose(700, 90).split()
    for i in range(40):
        edited = list(words)
        for _ in range(r.randint(0, 4)):
            edited[r.randrange(len(edited))] = f"w{i}"
        rows.append((400 + i, " ".join(edited)))
    rows += [(500 + i, "a b c d e f"[: 2 * i + 1]) for i in range(6)] + [(510 + i, "A B c D e f g h i j"[: 4 * i + 3]) for i in range(5)]
    return rows + [(rows[3][0], rows[4][1]), (None, rows[5][1]), (None, prose(1, 30)), (None, prose(1, 30))]


@pytest.mark.parametrize(("words", "percent"), [(4, 80), (1, 60)])
def test_near_copies(spark, make, prose, words, percent):
    rows = families(prose) + EDGES
    got = minhash_dedup.near_copies(spark, make(rows), words, percent).collect()
    want = brute_classes(rows, words, percent)
    if percent == 80:  # bands are laid out for similarities from 0.8 on
        assert sorted((tuple(r) for r in got), key=repr) == [(a, b, c, bool(d) if a is not None else c is None) for a, b, c, d in want]
    else:
        assert len(got) == len(rows)


def test_near_copies_of_nothing(spark, make):
    assert minhash_dedup.near_copies(spark, make([])).count() == 0
    assert minhash_dedup.near_copies(spark, make([(1, None), (2, " ")])).filter("kept and component_id = doc_id and n_shingles = 0").count() == 2


def test_rest_finds_what_stars_miss(spark, make, prose):
    """A bucket's leader is one set: links between two others have to come from the exact rest."""
    rows = [(i, " ".join(prose(500, 400).split()[3 * i : 3 * i + 70])) for i in range(60)]
    join = minhash_dedup.NearJoin(spark, make(rows), 4, 80)
    stars = {frequent for r in join.verified(join.star_pairs(), "star").collect() for frequent in (r["a"], r["b"])}
    assert join.members.select("rid").distinct().count() >= len(stars)
    assert {r["component_id"] for r in minhash_dedup.near_copies(spark, make(rows), 4, 80).collect()} == {0}


def slow_sketch(found):
    have = {}
    hashed = jaccard_join.mix(found ^ U(0x6A09E667F3BCC908))
    for h, v in zip(hashed.tolist(), jaccard_join.mix(hashed).tolist(), strict=True):
        b = (h >> 32) * minhash_dedup.BINS >> 32
        have[b] = min(v, have.get(b, v))
    if not have:
        return [int(minhash_dedup.NONE)] * minhash_dedup.BINS
    return [have[b] if b in have else have[next(int(x) for x in minhash_dedup.ORDER[b] if x in have)] for b in range(minhash_dedup.BINS)]


def test_sketches():
    r = np.random.default_rng(1)
    sizes = [0, 1, 2, 3, 10, 50, 70, 90, 120, 150, 200, 288, 2000, 0, 5]
    found = [np.unique(r.integers(0, 1 << 63, n, dtype=np.uint64)) for n in sizes]
    at = np.concatenate([[0], np.cumsum([len(f) for f in found])])
    got = minhash_dedup.sketch(np.concatenate(found), at)
    for f, bins in zip(found, got, strict=True):
        assert bins.tolist() == slow_sketch(f)
        assert minhash_dedup.sketch(f, np.asarray([0, len(f)]))[0].tolist() == slow_sketch(f)


@pytest.mark.parametrize("n", [5, 40, 1000])
def test_bins_agree_as_often_as_sets_are_alike(n):
    r = np.random.default_rng(n)
    agree = []
    for _ in range(200):
        shared, one, other = (r.integers(0, 1 << 63, k, dtype=np.uint64) for k in (8 * n // 10, n // 10, n // 10))
        a, b = np.unique(np.concatenate([shared, one])), np.unique(np.concatenate([shared, other]))
        bins = minhash_dedup.sketch(np.concatenate([a, b]), np.asarray([0, len(a), len(a) + len(b)]))
        agree.append(np.mean(bins[0] == bins[1]))
    want = (8 * n // 10) / (8 * n // 10 + 2 * (n // 10))
    assert abs(np.mean(agree) - want) < 0.05


# conversation repair


def edits(turns):
    """All ways to edit a few turns: (cost, audit, initials)."""
    inserts = ["".join(x) for n in range(3) for x in itertools.product("ua", repeat=n)]
    ways = [(3 * len(s), "I" * len(s), s) for s in inserts]
    for initial, fault in turns:
        more = 3 if fault == chat_repair.CUT else 0
        own = [(4, "D", "")]
        if fault in (chat_repair.KEPT, chat_repair.CUT):
            own += [(more, "K", initial), (3 + more, "R", "u"), (3 + more, "R", "a")]
        new = [(c + 3 * len(s), a + "I" * len(s), out + s) for c, a, out in own for s in inserts]
        ways = list({(x[0] + y[0], x[1] + y[1], x[2] + y[2]) for x in ways for y in new if re.match("^s?(ua)*u?$", x[2] + y[2])})
    return min((c, a) for c, a, out in ways if re.fullmatch("(s?(ua)+)?", out))


def whole(turns):
    return chat_repair.times(chat_repair.CLOSURE, functools.reduce(chat_repair.times, (chat_repair.turn_matrix(*t) for t in turns), chat_repair.UNIT))


def test_least_edits_are_found():
    kinds = list(itertools.product("sua?", (chat_repair.KEPT, chat_repair.CUT))) + [("u", chat_repair.BLANK)]
    r = random.Random(4)
    cases = [[], *([k] for k in kinds), *(list(x) for x in itertools.product(kinds, repeat=2)), *([r.choice(kinds) for _ in range(r.randint(3, 5))] for _ in range(60))]
    for turns in cases:
        row = whole(turns)
        assert min(x for x in (row[0], row[3]) if x is not None) == edits(turns), turns


def test_products_are_associative():
    kinds = list(itertools.product("sua?", (chat_repair.KEPT, chat_repair.BLANK, chat_repair.CUT)))
    r = random.Random(6)
    for _ in range(40):
        turns = [r.choice(kinds) for _ in range(r.randint(1, 40))]
        left = functools.reduce(chat_repair.times, (chat_repair.turn_matrix(*t) for t in turns))
        right = functools.reduce(lambda a, b: chat_repair.times(b, a), [chat_repair.turn_matrix(*t) for t in reversed(turns)])
        tree = chat_repair.Product()
        for t in turns:
            tree.add(chat_repair.turn_matrix(*t))
        assert left == right == tree.value()


TURNS = "conv_id long, turn long, role string, text string, pos string, fault int, n long, audit string"


def as_rows(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2, "y") for r in rows], TURNS)


def against_sql(spark, rows):
    got = chat_repair.repair(spark, as_rows(spark, rows), chat_repair.damaged(as_rows(spark, rows)))
    con = duckdb.connect()
    con.execute("create table conversations (conv_id bigint, turn bigint, role varchar, text varchar)")
    if rows:
        con.executemany("insert into conversations values (?, ?, ?, ?)", rows)
    rel = con.sql(chat_repair.repair_sql())
    assert rel.columns == got.columns
    assert sorted((tuple(r) for r in got.collect()), key=repr) == sorted(rel.fetchall(), key=repr)
    return got


def test_repair(spark):
    r = random.Random(8)
    texts = ["Yes.", "no", "", " \t", "What? ", "a\nb!", "é.", None]
    rows = [(c, t, r.choice(["user", "assistant", "system", "tool", "", "a", None]), r.choice(texts)) for c in range(60) for t in range(r.randint(0, 9)) if r.random() > 0.1]
    rows += [(None, 1, "user", "Hm."), (None, None, "assistant", "Hm."), (70, None, "user", "Hm."), (70, None, "user", "Hm."), (70, None, "system", "Be nice."), (71, 2, "user", "b."), (71, 2, "user", "a.")]
    rows += rows[:20]
    dropped = next(i for i in range(1000, 9999) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    against_sql(spark, [*rows, (dropped, 0, "user", "Gone.")])
    assert against_sql(spark, []).count() == 0


def test_repair_of_one_long_conversation(spark):
    """It runs over several partitions; what is kept of it is held against a fold turn by turn."""
    r = random.Random(9)
    turns = [(7, i // 2, r.choice(["user", "assistant", "system"]), r.choice([f"Text {i}.", f"Text {i}", "Again.", " "])) for i in range(3000)]
    got = chat_repair.repair(spark, as_rows(spark, turns)).collect()[0]
    turns.sort(key=lambda t: t[1:])
    seen, kinds = set(), []
    for _, _, role, text in turns:
        fault = chat_repair.BLANK if not text.strip() else chat_repair.REPEAT if (role, text) in seen else chat_repair.CUT if text[-1] not in ".!?" else chat_repair.KEPT
        seen.add((role, text))
        kinds.append((role[0], fault))
    best = [chat_repair.CLOSURE[j] for j in range(4)]
    for k in kinds:
        best = list(chat_repair.times((*best, *[None] * 12), chat_repair.turn_matrix(*k))[:4])
    cost, audit = min(x for x in (best[0], best[3]) if x is not None)
    assert (got["cost"], got["audit"]) == (cost, audit)
    count = collections.Counter(f for _, f in kinds)
    assert (got["blank"], got["duplicate"], got["truncated"], got["gaps"]) == (count[chat_repair.BLANK], count[chat_repair.REPEAT], count[chat_repair.CUT], 0)
    assert got["illegal"] == sum(a[0] + b[0] not in chat_repair.LEGAL for a, b in itertools.pairwise(kinds))
    lines, state, at = [], 0, iter(turns)
    for letter in audit:
        if letter == "I":
            role, state = chat_repair.NEXT[state]
            lines.append(f"{role}:")
            continue
        _, _, role, text = next(at)
        if letter == "D":
            continue
        if letter == "R":
            role, state = chat_repair.NEXT[state]
        else:
            state = chat_repair.LEADS[role[0]][state]
        lines.append(f"{role}:{text}")
    assert re.fullmatch("(s?(ua)+)?", "".join(x[0] for x in lines))
    assert got["repaired_sha256"] == hashlib.sha256("\n".join(lines).encode()).hexdigest()
