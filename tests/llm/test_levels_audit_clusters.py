"""Online packing, filter audit and clustering against brute force, with the odd rows."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict
from itertools import permutations

import duckdb
import numpy as np
import pandas as pd
import pyarrow as pa
import pytest

import __spark_entry__ as entry_mod
from compare import compare
from railyard.llm import audit, catalog, common, levels, packing, subvectors

WORDS = re.compile("[^\x20\x09-\x0d]+")
LONG = " ".join(f"word{i % 977}x{i % 13}" for i in range(20_000))
PLAIN = " ".join(f"tok{i}" for i in range(300))
SCHEMA = "doc_id long, text string, source string, part string, mask int, digest string, n long, step int, _id long"
ODD = [
    (1, None, "a"), (2, "", "a"), (3, " \n\t ", None), (4, "one two", ""), (5, PLAIN, "b"), (5, PLAIN, "b"),
    (5, PLAIN, "c"), (6, PLAIN, "b"), (7, LONG, "a"), (8, PLAIN + " #", "c"), (None, PLAIN, "b"), (None, None, "d"),
    (9, "A B C D", "a"), (10, "İstanbul ΣΑΣ 漢字 don't ½ x\x85y z\xa0w", "c"), (11, "the " * 400, "b"),
    (12, "The " * 400, "b"), (13, "THE & " * 300, None), (0, PLAIN, "e"), (-4, "one two", "e"), (14, "the " * 400, "a"),
]
LABELS = [(1, 1, 0), (5, 0, 1), (5, 1, None), (6, 1, 1), (9, None, 1), (13, 1, 0), (None, 1, 1), (99, 1, 1), (8, 0, 0)]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(d, t, s, "x", 1, "y", 2, 3, 4) for d, t, s in ODD], SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(*r, 7) for r in LABELS], "doc_id long, quality int, toxic int, n int")


def test_small_batches_keep_every_row():
    texts = ["x" * n for n in (5, 90_000, 0, 7, 300, 2_000, 1)] * 9
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], ["t"])
    got = list(common.small_batches(iter([batch.slice(0, 0), batch]), 1000))
    assert [t for b in got for t in b.column(0).to_pylist()] == texts
    assert all(b.num_rows == 1 or b.nbytes <= 1000 for b in got) and all(b.num_rows for b in got)


# ------------------------------------------------------------- online packing

def whole_ids(text):
    tok = packing.word_tokenizer(catalog.word_vocabulary()).tok
    return np.array(tok.encode(text or "", add_special_tokens=False).ids + [levels.CLOSING_ID], "<u4")


def no_padding(lengths, window):
    return all(n == window or n & (n - 1) == 0 for n in lengths)


def test_level_rule_takes_the_least_sum_of_squares():
    rng = np.random.default_rng(11)
    packer, held = levels.FillLevels(32), Counter()
    for s in rng.integers(1, 32, 600).tolist():
        def squares(level):
            after = held.copy()
            after[level] -= level > 0
            after[level + s] += level + s < 32
            return sum(n * n for n in after.values())
        fits = [0, *(h for h, n in held.items() if n and h + s <= 32)]
        level = packer.level_for(s)
        assert level == max(h for h in fits if squares(h) == min(map(squares, fits)))
        packer.add(1, np.zeros(s, "<u4").tobytes())
        held[level] -= level > 0
        held[level + s] += level + s < 32
        assert [int(n) for n in packer.count[:32]] == [held[h] for h in range(32)]
        assert [len(x) for x in packer.held] == [held[h] for h in range(32)]
    assert packer.n_open == sum(held.values())


@pytest.mark.parametrize("most", [4, 1000])
def test_online_windows_hold_every_id_once_without_padding(most):
    rng, packer, docs, done = np.random.default_rng(2), levels.FillLevels(64, most), {}, []
    for d in range(500):
        docs[d] = rng.integers(0, 9, int(rng.exponential(40)) + 1).astype("<u4")
        packer.add(d, docs[d].tobytes())
        done += packer.take()
        assert packer.n_open < most
    packer.close()
    done += packer.take()
    lengths = [sum(len(p[2]) // 4 for p in w) for w in done]
    assert no_padding(lengths, 64) and sum(n < 64 for n in lengths) <= 6
    got = defaultdict(dict)
    for d, start, ids, total in (p for w in done for p in w):
        assert total == len(docs[d]) and start not in got[d]
        got[d][start] = ids
    assert all(b"".join(x for _, x in sorted(got[d].items())) == ids.tobytes() for d, ids in docs.items())
    if most == 1000:                 # besides whole windows, only what was open at the end is cut
        assert sum(len(x) - (len(docs[d]) - 1) // 64 - 1 for d, x in got.items()) < 60


@pytest.mark.parametrize("parts", [1, 7])
def test_online_pieces_match_the_tokenizer(odd, empty, parts):
    got = levels.pack_online(odd.repartition(parts), catalog.word_vocabulary(), window=64, most=5).toPandas()
    texts = defaultdict(list)
    for d, t, _ in ODD:
        texts[d].append(whole_ids(t))
    spans = defaultdict(Counter)
    for r in got.itertuples():
        d = None if pd.isna(r.doc_id) else int(r.doc_id)
        assert any(len(ids) == r.doc_tokens and zlib.crc32(ids[r.start:r.start + r.length].tobytes()) == r.ids_crc32
                   for ids in texts[d])
        spans[d, r.doc_tokens].update(range(r.start, r.start + r.length))
    for (d, n), at in spans.items():
        assert at == Counter(list(range(n)) * sum(len(ids) == n for ids in texts[d]))
    assert {k for k in spans} == {(d, len(i)) for d, x in texts.items() for i in x}
    sizes = []
    for _, seq in got.sort_values("offset").groupby("sequence_id"):
        sizes.append(int(seq["length"].sum()))
        assert (seq["offset"].to_numpy() == np.cumsum(seq["length"]) - seq["length"]).all()
    assert no_padding(sizes, 64)
    assert levels.pack_online(empty, catalog.word_vocabulary()).count() == 0


def test_online_sequences_are_the_pieces_themselves(odd):
    vocabulary = catalog.word_vocabulary()
    one = odd.coalesce(1)
    pieces = {(r["sequence_id"], r["offset"]): r for r in levels.pack_online(one, vocabulary, 64).collect()}
    n = 0
    for r in levels.online_sequences(one, vocabulary, 64).collect():
        at = 0
        for d, start, length in zip(r["doc_ids"], r["starts"], r["lengths"], strict=True):
            p = pieces[r["sequence_id"], at]
            ids = np.array(r["ids"][at:at + length], "<u4").tobytes()
            assert (p["doc_id"], p["start"], p["length"], p["ids_crc32"]) == (d, start, length, zlib.crc32(ids))
            at, n = at + length, n + 1
        assert at == len(r["ids"])
    assert n == len(pieces)


def test_online_query_pads_nothing(spark, sf_dir):
    got = catalog.QUERIES["op11_online_levels"](spark, sf_dir).toPandas()
    sizes = got.groupby("sequence_id")["length"].sum()
    assert no_padding(sizes.tolist(), 2048)
    assert got.groupby("doc_id")["length"].sum().equals(got.groupby("doc_id")["doc_tokens"].first().rename("length"))
    assert (sizes == 2048).mean() > 0.7


# ------------------------------------------------------------- filter audit

def brute_audit(docs, labels):
    least = {}
    for d, t, _ in docs:
        if d is not None:
            least[t or ""] = min(least.get(t or "", d), d)
    failed = []
    for d, t, s in docs:
        t = t or ""
        words = WORDS.findall(t)
        fails = {"A"} if len(words) < 200 else set()
        fails |= {"B"} if 100 * len(set(words)) < 50 * len(words) else set()
        fails |= {"C"} if 100 * len(re.findall("[A-Z]", t)) > 2 * len(t) else set()
        fails |= {"D"} if re.search("[#$%&*|]", t) else set()
        fails |= {"E"} if d is not None and d > least[t] else set()
        has = [x for x in labels if d is not None and x[0] == d]
        failed.append((s or "", fails, any(x[1] == 1 for x in has), any(x[2] == 1 for x in has)))
    rows, shapley = [], Counter()
    for part in {f[0] for f in failed}:
        mine = [f for f in failed if f[0] == part]
        for order in permutations("ABCDE"):
            left = mine
            for k, c in enumerate(order, 1):
                out = [f for f in left if c in f[1]]
                left = [f for f in left if c not in f[1]]
                shapley[part, c] += len(out)
                rows.append([part, "".join(order), k, len(left), len(out),
                             sum(c in f[1] for f in mine) - len(out), sum(f[1] == {c} for f in mine),
                             sum(f[2] for f in out), sum(f[3] for f in out), c])
    return sorted((*r[:9], shapley[r[0], r[9]]) for r in rows)


def test_audit_matches_every_order_applied(spark, odd, empty, labels):
    assert sorted(map(tuple, audit.audited(odd, labels).collect())) == brute_audit(ODD, LABELS)
    assert audit.audited(empty, labels).count() == 0
    bare = [(d, t, None) for d, t, _ in ODD]
    no_source = spark.createDataFrame([(d, t) for d, t, _ in ODD], "doc_id long, text string")
    assert sorted(map(tuple, audit.audited(no_source, labels.limit(0)).collect())) == brute_audit(bare, [])


def test_audit_equals_its_statement_on_odd_rows(odd, labels):
    con = duckdb.connect()
    con.register("documents", pd.DataFrame(ODD, columns=["doc_id", "text", "source"]).astype({"doc_id": "Int64"}))
    con.register("labels", pd.DataFrame(LABELS, columns=["doc_id", "quality", "toxic"]).astype("Int64"))
    ok, msg = compare(audit.audited(odd, labels), con, audit.SQL)
    assert ok, msg


def test_intervals_tile_the_ranks():
    """Every mask leaves once in every order."""
    seen = Counter()
    for mask, step, first, after in audit.removal_intervals():
        for r in range(first, after):
            order = audit.orders()[r]
            assert mask >> audit.LETTERS.index(order[step - 1]) & 1
            assert not any(mask >> audit.LETTERS.index(c) & 1 for c in order[:step - 1])
            seen[mask, r] += 1
    assert set(seen.values()) == {1} and len(seen) == 31 * 120


# ------------------------------------------------------------- clustering

def brute_clusters(rows, k, rounds, dims):
    kept = [(v, [int(np.floor(np.float64(x) * 64)) for x in e]) for v, e in rows
            if e is not None and len(e) == dims and all(x is not None and np.isfinite(x) for x in e)]
    key = lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1])
    centroids = [list(v) for _, v in sorted(kept, key=key)[:k]]

    def nearest():
        out = []
        for v, a in kept:
            d = [sum((x - y) ** 2 for x, y in zip(a, c, strict=True)) for c in centroids]
            out.append((v, d.index(min(d)), min(d), a))
        return out
    for _ in range(rounds):
        found = nearest()
        for c in range(len(centroids)):
            mine = [f[3] for f in found if f[1] == c]
            if mine:
                centroids[c] = [sum(x) // len(mine) for x in zip(*mine, strict=True)]
    found = nearest()
    inertia = Counter()
    for f in found:
        inertia[f[1]] += f[2]
    hashes = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((f[0], f[1], f[2], inertia[f[1]], sum(inertia.values()), hashes[f[1]]) for f in found), key=repr)


def vectors(n, dims, seed):
    rng = np.random.default_rng(seed)
    rows = [(i if i % 9 else None, [float(np.float32(x)) for x in rng.normal(0, 0.2, dims)]) for i in range(n)]
    rows += [rows[3], (rows[4][0], rows[5][1]), (None, None), (7, []), (8, [0.5] * (dims - 1)), (9, [0.5] * (dims + 1)),
             (10, [None] + [0.1] * (dims - 1)), (11, [float("nan")] * dims), (12, [float("-inf")] + [0.0] * (dims - 1)),
             (13, [-0.0] * dims), (14, [1000.25] * dims), (15, [-1000.25] * dims)]
    return rows + [(20 + i, [0.25] * dims) for i in range(40)]


@pytest.mark.parametrize("dims,width,chunk", [(64, 2, 50), (64, 3, 1 << 16), (5, 2, 7), (5, 8, 7)])
def test_clusters_match_brute_force(spark, dims, width, chunk):
    rows = vectors(150, dims, dims)
    df = spark.createDataFrame([(v, e, 1, 2) for v, e in rows],
                               "vec_id long, embedding array<float>, cluster int, distance int").repartition(3)
    got = subvectors.clustered(df, 16, 3, dims, 64, width, chunk)
    assert sorted(map(tuple, got.collect()), key=repr) == brute_clusters(rows, 16, 3, dims)


def test_few_or_no_vectors(spark):
    schema = "vec_id long, embedding array<double>"
    rows = [(1, [0.1] * 64), (1, [0.1] * 64), (None, [0.3] * 64), (2, [1e30] + [0.0] * 63)]
    got = subvectors.clustered(spark.createDataFrame(rows, schema))
    assert sorted(map(tuple, got.collect()), key=repr) == brute_clusters(rows[:3], 16, 3, 64)
    none = subvectors.clustered(spark.createDataFrame([], schema))
    assert none.count() == 0 and none.dtypes == got.dtypes


def test_dictionaries_lose_nothing():
    rng = np.random.default_rng(1)
    a = rng.integers(-9, 9, (300, 7))
    a[100:200] = a[5]
    for width in (1, 2, 3, 7, 9):
        codes, words = subvectors.encode(a, width)
        assert (np.concatenate([w[codes[:, b]] for b, w in enumerate(words)], axis=1) == a).all()
        assert all(len(np.unique(w, axis=0)) == len(w) for w in words)
        c = rng.integers(-9, 9, (4, 7))
        d = subvectors.distances(codes, words, c)
        assert (d == ((a[:, None] - c[None]) ** 2).sum(-1)).all()
        cluster = d.argmin(1)
        want = [a[cluster == i].sum(0) for i in range(4)]
        assert (subvectors.cluster_sums(codes, words, cluster, 4) == want).all()


@pytest.mark.parametrize("name", ["op12_filter_audit", "op13_subvector_clusters"])
def test_query_equals_its_statement(spark, sf_dir, con, name):
    ok, msg = compare(entry_mod.queries()[name](spark, sf_dir), con, entry_mod.oracle_sql()[name])
    assert ok, msg
