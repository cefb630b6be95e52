"""Filter audit, suffix dedup and spelling variants against plain models, and their edge rows."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import pandas as pd
import pytest
from conftest import SF_ORACLE
from pyspark.sql import functions as F

from callfacts.llm import filter_audit, spelling, suffix_dedup
from callfacts.llm.common import staged
from callfacts.llm.queries import QUERIES

PROSE = "One two three four five. " * 30
TEXTS = [PROSE, "", " \n\t ", None, " ".join(f"word{i % 997} x{i}" for i in range(60_000)), "naïve 日本 # ÀÉÎõü\x85ÀÉÎõü"]


@pytest.fixture(scope="module")
def edge(spark):
    """Null, empty and long texts, repeated rows and ids, null ids, and columns named as the operators name theirs."""
    rows = [(i, t, None if i == 2 else f"s{i % 2}") for i, t in enumerate(TEXTS)]
    rows += [rows[0], rows[0], rows[3], (None, PROSE, None), (None, None, "s1"), (4, "other " + PROSE, "s1"), (9, PROSE, "s0"), (9, PROSE, "s1")]
    names = "doc_id long, text string, source string, n int, mask int, part string, prefix string, n_bytes int, kept string, _id int, word string"
    return staged(spark.createDataFrame([(*r, 1, 2, "p", "q", 3, "k", 4, "w") for r in rows], names), "edge")


def brute_audit(rows, labels):
    """``rows``: id, text, part; ``labels``: id -> (quality, toxic)."""
    ids = defaultdict(list)
    for i, t, _ in rows:
        if i is not None:
            ids[t or ""].append(i)
    count: Counter = Counter()
    for i, t, p in rows:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        caps = sum("A" <= c <= "Z" for c in t)
        copy = i is not None and min(ids[t]) < i
        fails = (len(w) < 50, 100 * len(set(w)) < 65 * len(w), 100 * caps > 5 * len(t), bool(set(t) & set("#$%&*|")), copy)
        good, toxic = labels.get(i, (0, 0))
        count[(p or "", fails, good == 1, toxic == 1)] += 1
    out = {}
    for part in {k[0] for k in count}:
        total: Counter = Counter()
        for order in permutations("ABCDE"):
            for step, name in enumerate(order, 1):
                r = Counter()
                for (p, fails, good, toxic), n in count.items():
                    if p != part:
                        continue
                    mine, gone = fails["ABCDE".index(name)], any(fails["ABCDE".index(x)] for x in order[: step - 1])
                    here = mine and not gone
                    r.update(kept=n * (not mine and not gone), removed=n * here, redundant=n * (mine and gone))
                    r.update(unique=n * (mine and sum(fails) == 1), good=n * (here and good), toxic=n * (here and toxic))
                total[name] += r["removed"]
                out[part, "".join(order), step] = r
        for (p, order, step), r in out.items():
            if p == part:
                r["shapley"] = total[order[step - 1]]
    return {k: tuple(r[x] for x in ("kept", "removed", "redundant", "unique", "good", "toxic", "shapley")) for k, r in out.items()}


@pytest.mark.parametrize("options", [{}, dict(prefix_bytes=500, salt_rows=1)])
def test_audit_matches_brute_force(spark, edge, options):
    labels = spark.createDataFrame([(0, 1, 0), (0, 0, 1), (9, 0, 1), (4, None, 1), (None, 1, 1)], "doc_id long, quality int, toxic int")
    got = filter_audit.audit(filter_audit.masks(edge, **options), labels).collect()
    want = brute_audit([tuple(r) for r in edge.select("doc_id", "text", "source").collect()], {0: (1, 1), 9: (0, 1), 4: (0, 1)})
    assert len(got) == len(want) == 3 * 600
    assert {(r.part, r.filter_order, r.step): tuple(r)[3:] for r in got} == want


def test_audit_of_empty_tables(spark, edge):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit(filter_audit.masks(edge.limit(0)), labels).count() == 0
    assert filter_audit.audit(filter_audit.masks(edge), labels).where("good_lost + toxic_lost > 0").count() == 0


def test_trie_holds_the_smallest_id_of_each_text():
    rng = random.Random(3)
    texts = ["".join(rng.choice("ab") for _ in range(rng.randrange(9))).encode() for _ in range(400)]
    trie, least = filter_audit.Trie(), {}
    ends = []
    for k, t in enumerate(texts):
        i = rng.randrange(1000)
        least[t] = min(least.get(t, i), i)
        ends.append(trie.insert(t, i))
    assert all(trie.least[e] == least[t] for e, t in zip(ends, texts))
    assert len(set(ends)) == len(trie.least) == len(set(texts))


def test_hot_copies_are_thinned_over_salts(spark):
    rows = [(i, PROSE if i % 2 else PROSE + "x" * (i % 5), "s") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(40)
    got = filter_audit.masks(docs, prefix_bytes=2000, salt_rows=4).collect()
    first = {}
    for i, t, _ in rows:
        first.setdefault(t, i)
    want = {i: first[t] < i for i, t, _ in rows}
    assert {r.doc_id: bool(r.mask >> 4) for r in got} == want and sum(r.n for r in got) == 300


def brute_cut(rows):
    """``id, bytes`` -> bytes removed, runs, what is kept."""
    first = {}
    for i, t in rows:
        for k in range(len(t) - 49):
            w = t[k : k + 50]
            first[w] = min(first.get(w, i), i)
    out = {}
    for i, t in rows:
        gone = bytearray(len(t))
        for k in range(len(t) - 49):
            if first[t[k : k + 50]] < i:
                gone[k : k + 50] = b"\x01" * 50
        runs = len(re.findall(b"\x01+", bytes(gone)))
        out[i, t] = (sum(gone), runs, bytes(c for c, g in zip(t, gone) if not g))
    return out


def cuts_of(df, id_col="doc_id", stem=("n_removed", "n_spans", "kept")):
    rows = df.select(id_col, F.col("text").cast("binary").alias("t"), *stem).collect()
    return {(r[0], bytes(r.t or b"")): (r[2], r[3], bytes(r[4] or b"")) for r in rows}


def test_suffix_query_matches_brute_force(spark):
    docs = spark.read.parquet(f"{SF_ORACLE}/documents.parquet").select("doc_id", "text").collect()
    want = brute_cut([(r.doc_id, (r.text or "").encode()) for r in docs])
    got = QUERIES["op12_suffix_dedup"](spark, SF_ORACLE).collect()
    have = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got}
    assert have == {i: (len(t), n, k, hashlib.sha256(kept).hexdigest()) for (i, t), (n, k, kept) in want.items()}
    assert sum(n > 0 for n, _, _ in want.values()) > 100


@pytest.mark.parametrize("options", [{}, dict(part_bytes=2000, batches=9), dict(part_bytes=3000, hot_regions=3, sample=1, batches=3)])
def test_suffix_dedup_matches_brute_force(spark, options):
    rng = random.Random(5)
    shared = "".join(rng.choice("abcd ") for _ in range(400))
    texts = []
    for k in range(120):
        own = "".join(rng.choice("abcdefgh é") for _ in range(rng.randrange(150)))
        a = rng.randrange(330)
        texts.append(rng.choice([own, own + shared[a : a + rng.randrange(45, 120)] + own[:60], "z" * rng.randrange(140), "ab" * 40 + own]))
    texts += texts[::7]
    rows = [(k // 2 if k > 100 else k, t) for k, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    want = brute_cut([(i, t.encode()) for i, t in rows])
    assert cuts_of(suffix_dedup.dedup(docs, **options)) == want
    assert sum(n > 0 for n, _, _ in want.values()) > 20


def test_suffix_dedup_of_edge_rows(spark, edge):
    got = suffix_dedup.dedup(edge)
    assert got.columns == [*edge.columns, "n_bytes_", "n_removed", "n_spans", "kept_"]
    rows = got.select("doc_id", "text", F.col("n_bytes_").alias("b"), F.col("n_removed").alias("r"), F.col("kept_").alias("k")).collect()
    assert len(rows) == edge.count()
    for r in rows:
        assert (r.k is None) == (r.text is None) and r.b == len((r.text or "").encode())
        if r.doc_id is None or r.doc_id in (0, 1, 2, 3, 5):
            assert r.r == 0
    assert [r.r for r in rows if r.doc_id == 9] == [len(PROSE)] * 2
    assert suffix_dedup.dedup(edge.limit(0)).count() == 0


def test_levels_have_different_powers_of_two_and_grow_by_merging():
    rng = np.random.default_rng(1)
    family, total = suffix_dedup.Family(), 0
    for k in range(1, 14):
        text = rng.integers(97, 123, 70 * 20, dtype=np.uint8).tobytes()
        size = np.full(20, 70)
        region, start, end = family.add(np.full(20, k), size, text)
        assert len(region) == 0
        total += 20
        sizes = [lv.size for lv in family.levels]
        assert sizes == [1 << b for b in range(9, -1, -1) if k >> b & 1]
        assert sum(len(lv.key) for lv in family.levels) == total
        assert all((lv.key[1:] >= lv.key[:-1]).all() for lv in family.levels)
    region, start, end = family.add(np.full(20, 99), size, text)  # the last batch again
    assert sorted(region) == list(range(20)) and set(start) == {0} and set(end) == {70}
    assert sum(len(lv.key) for lv in family.levels) == total  # nothing new to hold


def test_equal_hashes_are_checked_by_their_bytes(monkeypatch):
    text = b"a" * 60 + b"b" * 60 + bytes(8)
    at, doc = np.array([0, 5, 60, 65]), np.array([4, 2, 9, 7])
    assert suffix_dedup.first_documents(text, at, doc).tolist() == [2, 2, 7, 7]
    monkeypatch.setattr(suffix_dedup, "_M2", np.uint64(0))  # every hash equal
    assert suffix_dedup.first_documents(text, at, doc).tolist() == [2, 2, 7, 7]


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(a) + 1 == len(b) and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_variants(rows):
    count: Counter = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 6:
                count[run] += 1
    count = {w: n for w, n in count.items() if n >= 5}
    holes = defaultdict(set)
    for w in count:
        for k in {w, *(w[:i] + w[i + 1 :] for i in range(len(w)))}:
            holes[k].add(w)
    near, form = {w: {v for k in {w, *(w[:i] + w[i + 1 :] for i in range(len(w)))} for v in holes[k] if one_edit(w, v)} for w in count}, {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-count[v], v), default=None)
        if best and count[best] >= 5 * count[w]:
            form[w] = best
    out = {}
    for w, n in count.items():
        root = w
        while root in form:
            root = form[root]
        out[w] = (form.get(w), root, n, len(near[w]), count[form[w]] if w in form else None)
    return out


def variants_of(df):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()}


def test_spelling_query_matches_brute_force(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF_ORACLE}/documents.parquet").select("doc_id", "text").collect()]
    want = brute_variants(docs)
    assert variants_of(QUERIES["op13_spelling"](spark, SF_ORACLE)) == want
    assert sum(v[0] is not None for v in want.values()) > 100


@pytest.mark.parametrize("list_words", [2, 2000])
def test_spelling_of_dense_vocabularies(spark, list_words):
    rng = random.Random(8)
    rows = []
    for k in range(60):
        stem = "stadtt" if k % 3 else "éàüabc"
        words = [stem[:i] + rng.choice("abé") + stem[i:] for i in range(7)] + [stem] * rng.randrange(8)
        rows.append((k, " ".join(words) + " ÀBCDEF×x abc-defghiĀjklmnop"))
    rows += [(None, "stadtt stadtt"), (7, None), (8, ""), rows[0], rows[0]]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute_variants(rows)
    assert variants_of(spelling.variants(docs, list_words=list_words)) == want and any(v[0] for v in want.values())


def test_spelling_follows_forms_to_the_last(spark):
    forms = [(f"w{i}", f"w{i + 1}") for i in range(11)]
    got = spelling.roots(spark.createDataFrame(forms, "word string, form string")).collect()
    assert {r.word: r.root for r in got} == {w: "w11" for w, _ in forms}


@pytest.mark.parametrize("letters", ["ab", "abcd"])
def test_scan_of_a_sorted_list_finds_every_pair(letters):
    rng = random.Random(2)
    for _ in range(400):
        size = rng.choice([1, 2, 3, 4, 5])
        words = sorted({"".join(rng.choice(letters) for _ in range(size + rng.randrange(2))) for _ in range(rng.choice([2, 5, 20, 60]))})
        want = [(i, j) for i, a in enumerate(words) if len(a) == size for j, b in enumerate(words) if one_edit(a, b)]
        assert sorted(spelling.scan(words, size)) == want


def test_spelling_of_edge_rows(spark, edge):
    want = brute_variants([tuple(r) for r in edge.select("doc_id", "text").collect()])
    assert variants_of(spelling.variants(edge)) == want
    assert spelling.variants(edge.limit(0)).count() == 0
    got = spelling.variants(edge).toPandas()
    assert list(got.columns) == ["word", "n", "n_near", "form", "form_n", "root"] and pd.notna(got.root).all()
