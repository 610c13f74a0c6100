"""Prefix trie, SentencePiece coding and whitening against brute force and the
library that the model file is made for."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
import sentencepiece

from oreflow.llm.op11_prefix_trie import (
    SpillingQueue, conversation_trie, numbered_turns, op11_prefix_trie, prefix_trie, rebuilt)
from oreflow.llm.op12_sentencepiece import Normalizer, _fields, decode, encode, model_path, op12_sentencepiece
from oreflow.llm.op13_whitening import op13_whitening, whiten
from oreflow.llm.registry import QUERIES, SQL
from oreflow.plans.verify import compare, duckdb_connection

TURNS = "conv_id bigint, turn bigint, role string, text string, depth int, c string"


def sha(x):
    return hashlib.sha256(x.encode()).hexdigest()


def sequences(rows):
    convs = defaultdict(list)
    for r in rows:
        if r[0] is not None:
            role, text = r[2] or "", r[3] or ""
            convs[r[0]].append((r[1] is not None, r[1] or 0, sha(f"{len(role.encode())}:{role}{text}"), (role, text)))
    return {c: [t[3] for t in sorted(v, key=lambda t: t[:3])] for c, v in convs.items()}


def rebuild(seqs):
    out = {}
    for c, own in seqs.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = seqs.get(c - c % 5, [])[:h] + own[h:]
    return out


def brute_trie(seqs):
    members = defaultdict(list)
    for c, s in seqs.items():
        for d in range(len(s) + 1):
            members[tuple(s[:d])].append(c)
    kids = defaultdict(int)
    for p in members:
        if p:
            kids[p[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for p, m in members.items():
        own = (len(m) - 1) * len(p[-1][1].encode()) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += p not in kids
            saved[p[:d]] += own
    return sorted((min(m), len(p), min(members[p[:-1]]) if p else -1, len(m), kids.get(p, 0), leaves[p], saved[p],
                   sha(",".join(str(c) for c in sorted(m) if len(seqs[c]) == len(p)))) for p, m in members.items())


def nodes(df):
    return sorted((r.conv_id, r.depth, -1 if r.parent_conv_id is None else r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves,
                   r.saved_tokens, r.ends_sha256) for r in df.collect())


@pytest.fixture(scope="module")
def turns(spark):
    rnd = random.Random(4)
    rows = []
    for c in range(60):
        start = rnd.randrange(3)
        for t in range(rnd.randint(1, 11)):
            rows.append((c, t, "user" if t % 2 else "assistant", f"é{start} {t}" if t < 6 else f"{c} {rnd.random()}", 1, "x"))
    for c in range(100, 130):                                   # one conversation many times over
        rows += [(c, t, "user", f"same {t}", 1, None) for t in range(10)]
    rows += [(201, None, None, None, 1, None), (201, 0, "user", None, 1, None), (201, 0, "user", "tie", 1, None),
             (201, 0, "user", "tie", 1, None), (202, 1, "user", "long " * 50_000, 1, None), (None, 1, "user", "of none", 1, None),
             (-7, 1, "user", "below nothing", 1, None), (206, 3, "system", "alone", 1, None)]
    rnd.shuffle(rows)
    return rows


def test_trie_equals_brute_force(spark, turns):
    df = spark.createDataFrame(turns, TURNS).repartition(3)
    seqs = sequences(turns)
    got = nodes(conversation_trie(df))
    assert got == brute_trie(seqs)
    back = {}
    for c, s in rebuild(seqs).items():
        back[c] = s
    # a small top, and a queue that must spill
    sequences_, convs = rebuilt(numbered_turns(df))
    want = brute_trie({c: s for c, s in back.items()})
    assert nodes(prefix_trie(sequences_, convs)) == want
    assert nodes(prefix_trie(sequences_, convs, least=3, queue=2)) == want
    none = spark.createDataFrame([], TURNS)
    assert conversation_trie(none).columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
                                               "saved_tokens", "ends_sha256"]
    assert conversation_trie(none).count() == 0


def test_trie_query_and_sql(spark, sf_small):
    ok, why = compare(spark, duckdb_connection(sf_small), sf_small, op11_prefix_trie, SQL["op11_prefix_trie"])
    assert ok, why


def test_spilling_queue_keeps_order():
    rnd = random.Random(1)
    q, n = SpillingQueue(20), []
    out = []
    for _ in range(3000):
        if rnd.random() < 0.6 or q.first() is None:
            x = (rnd.randrange(500), len(n))
            n.append(x)
            q.push(x)
        else:
            out.append(q.pop())
            assert q.first() is None or out[-1] <= q.first()
    while q.first() is not None:
        out.append(q.pop())
    assert sorted(out) == sorted(n) and q.runs > 10


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=model_path())


@pytest.fixture(scope="module")
def odd_texts():
    rnd = random.Random(9)
    texts = [None, "", " ", "  ", "a▁b  c ▁ ▁▁", "\0x", "日本語テキスト漢字" * 30, "x" * 5000, "<0x41></s><s><unk>", "é\n\n\tü",
             " " * 50 + "abc" + " " * 33, "😀👍🏽 a😀", "⁇ ⁇", "word " * 40_000, "�", "▁", "▁▁▁a▁▁", "the same", "the same"]
    return texts + ["".join(rnd.choice("abcdet ▁ \n日😀é0") for _ in range(rnd.randint(0, 150))) for _ in range(150)]


def test_pieces_equal_the_library(spark, library, odd_texts):
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(odd_texts)], "doc_id int, text string, ids string, Decoded int")
    coded = encode(df.repartition(2))
    assert coded.columns == ["doc_id", "text", "Decoded", "ids", "offsets"]
    rows = decode(coded).collect()
    assert len(rows) == len(odd_texts)
    for r in rows:
        text = odd_texts[r.doc_id] or ""
        ids = library.encode(text, add_eos=True)
        assert r.ids == ids
        assert r.decoded == library.decode(ids)
        spans = [(p.begin, p.end) for p in library.encode(text, return_type="proto").pieces]
        assert list(zip(r.offsets, r.offsets[1:]))[:-1] == spans
        assert r.offsets[0] == 0 and r.offsets[-1] == r.offsets[-2] == len(text.encode())
    assert decode(encode(df.limit(0))).count() == 0


def test_decoding_any_ids(spark, library):
    rnd = random.Random(2)
    lists = [[rnd.randrange(3, 700) if rnd.random() < 0.7 else rnd.randrange(32000) for _ in range(rnd.randint(0, 12))] for _ in range(300)]
    lists += [[1, 29871, 2], [2], [0, 0], [28705, 28705, 0x43], []]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lists)] + [(-1, None), (-2, [None, 40_000])], "n int, ids array<int>")
    got = {r.n: r.decoded for r in decode(df).collect()}
    assert got.pop(-1) is None
    assert got.pop(-2) == library.decode([0, 0])
    for i, x in enumerate(lists):
        assert got[i] == library.decode(x), x


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc_cf", "identity"])
@pytest.mark.parametrize("remove", [True, False])
def test_longest_prefix_normalisation(rule, remove):
    """The identity model has no character map: maps are taken from the library."""
    lib = sentencepiece.SentencePieceNormalizer(rule_name=rule, remove_extra_whitespaces=remove, add_dummy_prefix=True,
                                                escape_whitespaces=True)
    spec = dict(_fields(lib.serialized_normalizer_spec()))
    norm = Normalizer(spec.get(2, b""), True, remove, True)
    assert bool(norm.map.units) == (rule != "identity")
    rnd = random.Random(3)
    for _ in range(300):
        x = "".join(rnd.choice(["a", "é", "①", "ﬁ", "㍿", " ", "　", "\n", "\t", "Ａ", "ｶﾞ", "日", "😀", "ß", "İ", "​", "▁", " "])
                    for _ in range(rnd.randint(0, 25)))
        text, origin = norm(x.encode())
        want, place = lib.Normalize(x, with_offsets=True)
        assert text.decode() == want
        # the library counts characters, this operator bytes
        at = np.cumsum([0, *(len(c.encode()) for c in x)])
        starts = np.cumsum([0, *(len(c.encode()) for c in want)])
        assert origin[starts].tolist() == at[place].tolist()
    assert norm(b"a\xff\xe2\x82z")[0].decode().replace("▁", "") == "a���z"


def test_pieces_query(spark, sf_small, library):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()}
    rows = op12_sentencepiece(spark, sf_small).collect()
    assert len(rows) == len(docs)
    for r in rows:
        ids = library.encode(docs[r.doc_id], add_eos=True)
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256, r.covered_bytes) == (
            len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids)), len(docs[r.doc_id].encode()))


def brute_whitening(vectors):
    x = np.floor(64 * np.array(vectors, float)).astype(np.int64) + 1_000_000
    u = np.unique(x, axis=0)
    n, s = len(u), u.sum(0)
    away = u - s / n
    cov = away.T @ away / n
    e, v = np.linalg.eigh(cov)
    return x, n, s, cov, e[::-1], v[:, ::-1]


def test_whitening_query(spark, sf_small):
    table = spark.read.parquet(f"{sf_small}/embeddings.parquet").toPandas()
    x, n, s, cov, e, v = brute_whitening(table["embedding"].tolist())
    want = (x - s / n) @ v / np.sqrt(e)
    deviation = ((n * x - s) ** 2).sum(1)
    rows = op13_whitening(spark, sf_small).toPandas()
    assert len(rows) == len(table) * 16
    at = rows["vec_id"].map({i: k for k, i in enumerate(table["vec_id"])}).to_numpy()
    k = rows["component"].to_numpy() - 1
    assert (rows["n"] == n).all() and (rows["deviation"] == deviation[at]).all()
    sign = np.sign((rows["whitened"].to_numpy() * want[at, k]).reshape(-1, 16).sum(0))
    assert np.abs(rows["whitened"].to_numpy() * sign[k] - want[at, k]).max() < 1e-8
    assert np.abs(rows["explained"] / (e[k] / np.trace(cov)) - 1).max() < 1e-9
    assert rows["identity_error"].nunique() == 1 and rows["identity_error"].iloc[0] < 1e-9


def test_whitening_rows(spark):
    rnd = np.random.RandomState(5)
    base = rnd.randn(40, 4)
    rows = [(i, [float(c) for c in r], 1.0) for i, r in enumerate(base)]
    rows += [(100, [1e9, -1e9, 3e11, 0.5], None), (101, rows[0][1], None), (102, rows[0][1], None), (None, rows[1][1], None)]
    odd = [(200, None, None), (201, [1.0, None, 1.0, 1.0], None), (202, [1.0, float("nan"), 1.0, 1.0], None),
           (203, [float("inf"), 0.0, 0.0, 0.0], None)]
    other = [(300, [0.5, 0.25], None), (301, [], None)]
    df = spark.createDataFrame(rows + odd + other, "vec_id bigint, embedding array<double>, N double").repartition(3)
    got = whiten(df).collect()
    assert len(got) == len(rows) + len(other)
    assert whiten(df).columns == ["vec_id", "embedding", "n", "deviation", "whitened", "explained", "identity_error"]
    x, n, s, cov, e, v = brute_whitening([r[1] for r in rows])
    exact = {}
    for r, own in zip(rows, x):
        exact.setdefault(r[0], sum((n * int(a) - int(b)) ** 2 for a, b in zip(own, s)))
    for r in got:
        if r.vec_id is not None and r.vec_id >= 300:
            assert r.n == 1 and r.deviation == 0 and set(r.whitened) <= {0.0} and len(r.whitened) == len(r.embedding)
        else:
            assert r.n == n and int(r.deviation) == exact[r.vec_id] and len(r.whitened) == 4
    assert whiten(df.limit(0)).count() == 0
    assert {"op11_prefix_trie", "op12_sentencepiece", "op13_whitening"} <= set(QUERIES)


def test_whitening_is_exact_for_large_numbers():
    from oreflow.llm.op13_whitening import Whitening, _pairs
    rnd = random.Random(1)
    x = [[rnd.randrange(-10 ** 15, 10 ** 15) for _ in range(3)] for _ in range(50)]
    sums = [sum(r[i] for r in x) for i in range(3)]
    centre = [(2 * s + 50) // 100 for s in sums]
    i, j = _pairs(3)
    squares = [sum(((r[a] - centre[a]) + (r[b] - centre[b] if a != b else 0)) ** 2 for r in x) for a, b in zip(i, j)]
    f = Whitening.of([50, *sums], centre, squares)
    for a in range(3):
        for b in range(3):
            want = sum((50 * r[a] - sums[a]) * (50 * r[b] - sums[b]) for r in x) / 50 ** 3
            assert f.covariance[a, b] == pytest.approx(want, rel=1e-14)
