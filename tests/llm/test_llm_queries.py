"""The registered queries against DuckDB SQL, brute force, exact round trips or held-out labels."""

import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import xxhash
from conftest import SF_ORACLE
from oracle import compare, duck
from tokenizers import Tokenizer

from callfacts.llm import line_dedup, mixing, quality_rules
from callfacts.llm.queries import ORACLE_SQL, QUERIES


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF_ORACLE}/documents.parquet").orderBy("doc_id").toPandas()


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, name):
    c = compare(QUERIES[name](spark, SF_ORACLE), duck(SF_ORACLE), ORACLE_SQL[name])
    assert c.ok, c
    assert c.rows_spark > 0


def union(n, pairs):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]


def test_quality_rules_keep_good_and_drop_junk(spark):
    got = QUERIES["op2_quality_rules"](spark, SF_ORACLE).toPandas()
    got = got.merge(spark.read.parquet(f"{SF_ORACLE}/labels.parquet").toPandas(), on="doc_id")
    assert not got[got.quality == 0].kept.any()
    assert got[(got.quality == 1) & ~got.base_failed].kept.mean() > 0.99


@pytest.mark.parametrize(
    "name,label,n,held,sf,least",
    [("op1_toxicity", "toxic", 4, 2, "/root/testdata/sf0.1", 0.95), ("op7_quality_classifier", "quality", 5, 0, SF_ORACLE, 0.98)],
)
def test_scores_rank_held_out_labels(spark, name, label, n, held, sf, least):
    got = QUERIES[name](spark, sf).toPandas()
    assert len(got) == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert got.score.between(0, 1).all() and ((got.score >= 0.3) == (got.predicted == 1)).all()
    assert (got.held_out == (got.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % n) == held)).all()
    labels = spark.read.parquet(f"{sf}/labels.parquet").toPandas()
    m = got.merge(labels, on="doc_id")
    m = m[m.held_out]
    rank, y = m.score.rank().to_numpy(), m[label].to_numpy()
    auc = (rank[y == 1].sum() - y.sum() * (y.sum() + 1) / 2) / (y.sum() * (1 - y).sum())
    assert auc >= least
    assert (m.predicted == m[label]).mean() > 0.95


def test_token_files_round_trip(spark, docs):
    got = QUERIES["op3_token_files"](spark, SF_ORACLE).toPandas().sort_values("start").reset_index(drop=True)
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want, at = [], 0
    for i, text in zip(docs.doc_id, docs.text):
        ids = np.array([*library.encode(text, add_special_tokens=False).ids, 0], "<u4")
        want.append((i, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    assert list(got[["doc_id", "start", "n_tokens", "ids_crc32"]].itertuples(index=False, name=None)) == want


def check_packing(got, texts, window=4096):
    """Each id in exactly one piece, gapless sequences of full or power-of-two length."""
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    used = got.groupby("sequence_id").length.sum()
    assert (used <= window).all()
    assert all(u == window or u & (u - 1) == 0 for u in used)
    for _, s in got.sort_values("offset").groupby("sequence_id"):
        assert s.offset.tolist() == np.concatenate([[0], s.length.cumsum()[:-1]]).tolist()
    assert set(got.doc_id) == set(texts)
    for i, p in got.sort_values("start").groupby("doc_id"):
        ids = np.array([*library.encode(texts[i] or "", add_special_tokens=False).ids, 2], "<u4")
        assert (p.doc_tokens == len(ids)).all()
        assert p.start.tolist() == np.concatenate([[0], p.length.cumsum()[:-1]]).tolist()
        assert p.length.sum() == len(ids)
        for a, n, crc in zip(p.start, p.length, p.ids_crc32):
            assert crc == zlib.crc32(ids[a : a + n].tobytes())


def test_packing_places_every_id_once(spark, docs):
    check_packing(QUERIES["op10_packing"](spark, SF_ORACLE).toPandas(), dict(zip(docs.doc_id, docs.text)))


def simhash_by_hand(text):
    words = (text or "").encode().translate(bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))).split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    ones = Counter(b for s in shingles for h in [xxhash.xxh64(s, seed=42).intdigest()] for b in range(64) if h >> b & 1)
    return sum(1 << b for b, n in ones.items() if 2 * n > len(shingles))


def test_simhash_matches_brute_force(spark, docs):
    got = QUERIES["op8_simhash"](spark, SF_ORACLE).toPandas().sort_values("doc_id").reset_index(drop=True)
    prints = np.array([simhash_by_hand(t) for t in docs.text], np.uint64)
    assert got.fingerprint.tolist() == [f"{int(p):016x}" for p in prints]
    pairs = [(i, j + i) for i in range(len(prints)) for j in np.flatnonzero(np.bitwise_count(prints[i:] ^ prints[i]) <= 2)]
    assert got.component_id.tolist() == [docs.doc_id[r] for r in union(len(prints), pairs)]


def lines_by_hand(rows, run_words=50):
    """Lines to delete: in a run of so many words that occurs earlier; every run is compared."""
    seen, gone = {}, {}
    for i, text in rows:
        lines = [(k, x.split()) for k, x in enumerate(text.split("\n")) if x.split()]
        for p in range(len(lines)):
            for e in range(p + 1, len(lines) + 1):
                if sum(len(w) for _, w in lines[p:e]) >= run_words:
                    key = tuple(" ".join(w) for _, w in lines[p:e])
                    if key in seen and seen[key] < (i, p):
                        gone.setdefault(i, set()).update(range(lines[p][0], lines[e - 1][0] + 1))
                    seen.setdefault(key, (i, p))
    return {i: "\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone.get(i, ())) for i, t in rows}


def test_line_dedup_matches_brute_force(spark):
    rng = np.random.default_rng(4)
    pool = [" ".join(f"w{x}" for x in rng.integers(0, 40, rng.integers(1, 30))) for _ in range(25)]
    texts = ["\n".join([*rng.choice(pool, rng.integers(1, 9)).tolist(), *[""] * (i % 3 == 0)]) for i in range(300)]
    rows = list(enumerate(texts))
    got = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want = lines_by_hand(rows)
    assert {r.doc_id: r.text for r in got} == want
    assert sum(w != t for (_, t), w in zip(rows, want.values())) > 20


def test_line_dedup_query_keeps_first_copies(spark, docs):
    got = QUERIES["op5_line_dedup"](spark, SF_ORACLE).toPandas().set_index("doc_id")
    assert len(got) == len(docs)
    text = dict(zip(docs.doc_id, docs.text))
    for i in got.index[got.removed_lines == 0]:
        assert got.text[i] == text[i]
    first = {}
    for i, t in sorted(text.items()):
        if len(t.split()) >= 50 and t in first:  # a later whole copy
            assert not got.text[i].split()
        first.setdefault(t, i)


def test_embeddings_match_brute_force(spark, tmp_path):
    rng = np.random.default_rng(1)
    base = rng.normal(size=(300, 48))
    near = base[:120] + 0.02 * rng.normal(size=(120, 48))
    hot = base[:1] + 0.015 * rng.normal(size=(200, 48))
    x = np.r_[base, near, hot, base[:20], 3 * base[20:30]].astype("f4").astype(float)
    label = np.r_[np.arange(300) % 3, np.arange(120) % 3, np.zeros(200), np.arange(20) % 3, np.arange(20, 30) % 3].astype(int)
    rows = [(i, v.tolist(), int(k)) for i, (v, k) in enumerate(zip(x, label))]
    from callfacts.llm.embedding_dedup import near_duplicates

    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = near_duplicates(df, block=64).toPandas().sort_values("vec_id").reset_index(drop=True)
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    linked = (unit @ unit.T >= 0.98) & (label[:, None] == label)
    np.fill_diagonal(linked, False)
    assert got.n_links.sum() >= 0.99 * linked.sum() > 1000
    assert (got.n_links.to_numpy() <= linked.sum(1)).all()
    want = union(len(x), np.argwhere(linked).tolist())
    assert (got.component_id == want).mean() > 0.99
    assert (got.kept == (got.vec_id == got.component_id)).all()


def test_mixing_reaches_its_targets(spark):
    got = QUERIES["op4_mixing"](spark, "/root/testdata/sf0.1").toPandas()
    assert len(got) == 10_000 and got.probability.between(0, 1).all()
    expected, drawn = (got.tokens * got.probability).sum(), got.tokens[got.kept].sum()
    assert abs(expected / got.tokens.sum() - 0.7) < 0.001
    assert abs(drawn / expected - 1) < 0.05
    cells = got.groupby(["source", "lang", "topic"], as_index=False).tokens.sum()
    cells["likely"] = mixing.tempered(cells.tokens.to_numpy(float), 0.7)
    for margin in ("source", "lang", "topic"):
        want = cells.groupby(margin).likely.sum()
        have = (got.tokens * got.probability).groupby(got[margin]).sum()
        assert (have / want - 1).abs().max() < 0.01
    small = got.groupby("lang").tokens.sum().idxmin()  # small categories are raised
    rate = lambda rows: (rows.tokens * rows.probability).sum() / rows.tokens.sum()
    assert rate(got[got.lang == small]) > rate(got)


def test_cascade_stops_at_the_best_rule_first(spark):
    rules = quality_rules.RULES
    ordered = quality_rules.order_rules([(r, 1.0, 0.1 * i) for i, r in enumerate(rules)])
    assert [r.name for r in ordered] == [r.name for r in reversed(rules)]
    cheap = quality_rules.order_rules([(rules[0], 5.0, 0.5), (rules[1], 0.5, 0.4)])
    assert cheap[0].name == rules[1].name
