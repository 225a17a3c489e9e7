"""Byte BPE, hard negatives and cross-tokenizer alignment against the public libraries and brute force."""

import hashlib
import random
import time
from array import array
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from recordloom.llm import alignment, byte_bpe, hard_negatives
from recordloom.llm.common import table

P = pytest.importorskip("public_tokenizers")
FOLDER = "/root/testdata/sf0.001"
RANKS, BYTES, PIECES = P.path("byte_bpe_multi_50k.tiktoken"), P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")
ODD = [None, "", " ", "  a  b", "x▁y", "<|endoftext|> and </s>", "naïve 漢字 🎉\n\n x", "a\tb", "\0 z", " lead", "trail ", "é ﬁ", "<0x41>", "ー" * 50, "ab" * 3000, "same", "same"]
WIDE = "doc_id long, text string, ids int, n_a int, pair int, row_id int, doc int, ids_sha256 string"


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(i, t, 1, 2, 3, 4, 5, "h") for i, t in enumerate(ODD)] + [(None, "no id", 1, 2, 3, 4, 5, "h"), (15, "same", 1, 2, 3, 4, 5, "h")], WIDE)


# ---- byte BPE


@pytest.fixture(scope="module")
def pairs():
    return byte_bpe.BytePairs(byte_bpe.read_ranks(RANKS), P.PATTERN)


@pytest.fixture(scope="module")
def library(pairs):
    tiktoken = pytest.importorskip("tiktoken")
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=pairs.ranks, special_tokens={})


def test_ids_equal_the_library(pairs, library):
    rng, tokens = random.Random(5), list(pairs.ranks)
    texts = [b"".join(rng.choice(tokens) for _ in range(rng.randint(1, 7))).decode("utf8", "ignore") for _ in range(4000)]
    texts += ["".join(rng.choice("abcdeéñ汉字の ") for _ in range(rng.randint(1, 60))) for _ in range(2000)]
    texts += [t or "" for t in ODD] + ["a" * 2000, " " * 2000, "\n" * 500, "é" * 700]
    for text in texts:
        ids = pairs.encode(text)
        assert list(array("I", ids)) == library.encode_ordinary(text)
        assert pairs.decode(ids) == text.encode()


def test_one_long_match_takes_linear_time(pairs):
    def took(n):
        start = time.process_time()
        pairs.encode("ab" * n)
        return time.process_time() - start

    took(1000)
    assert took(400_000) < 20 * max(took(40_000), 0.05)


def test_any_table_of_merges():
    """Tables learned from random texts of few letters, where longest matches often mislead."""
    rng = random.Random(3)
    for _ in range(30):
        ranks, text = {bytes([b]): b for b in range(256)}, [bytes([rng.choice(b"abc")]) for _ in range(400)]
        for _ in range(25):
            (a, b), _n = Counter(zip(text, text[1:], strict=False)).most_common(1)[0]
            ranks.setdefault(a + b, len(ranks))
            joined, i = [], 0
            while i < len(text):
                both = text[i : i + 2] == [a, b]
                joined.append(a + b if both else text[i])
                i += 2 if both else 1
            text = joined
        own = byte_bpe.BytePairs(ranks, "[a-z]+")
        for _ in range(60):
            data = bytes(rng.choice(b"abc") for _ in range(rng.randint(1, 40)))
            assert [own.token[i] for i in own.encode_match(data)] == ([data] if data in ranks else own._merged(data, 1 << 30))


def test_a_small_memory_gives_the_same_ids(pairs, library):
    small = byte_bpe.BytePairs(pairs.ranks, P.PATTERN, keep=2000)
    text = " ".join(f"w{i % 400} été" for i in range(3000))
    assert list(array("I", small.encode(text))) == library.encode_ordinary(text)


def test_byte_bpe_query_and_odd_rows(spark, odd, library):
    docs = table(spark, FOLDER, "documents")

    def wanted(rows):
        for r in rows:
            ids = library.encode_ordinary(r["text"] or "")
            yield r["doc_id"], len(ids), hashlib.sha256(array("I", ids).tobytes()).hexdigest(), hashlib.sha256((r["text"] or "").encode()).hexdigest()

    from recordloom.llm.queries import QUERIES

    assert sorted(map(tuple, QUERIES["op11_byte_bpe"](spark, FOLDER).collect())) == sorted(wanted(docs.collect()))
    assert Counter(map(tuple, byte_bpe.round_trips(odd, RANKS, P.PATTERN).collect())) == Counter(wanted(odd.collect()))
    assert byte_bpe.round_trips(odd.limit(0), RANKS, P.PATTERN).count() == 0
    back = byte_bpe.decode(byte_bpe.encode(odd, RANKS, P.PATTERN), RANKS, P.PATTERN).collect()
    assert Counter((r["doc_id"], bytes(r["data"])) for r in back) == Counter((r["doc_id"], (r["text"] or "").encode()) for r in odd.collect())


# ---- hard negatives


def brute_negatives(rows, every=50):
    """``rows``: (vec_id, label, integers)."""
    out = []
    for i, label, x in rows:
        if i % every:
            continue
        scored = sorted((-sum(a * b for a, b in zip(x, y, strict=False)), j, other == label) for j, other, y in rows if j != i)
        for p, positive, _ in [s for s in scored if s[2]][:5]:
            window = [(-s, j) for s, j, same in scored if not same and 50 * -p <= 100 * -s <= 95 * -p]
            out += [(i, positive, rank + 1, j, -p, s) for rank, (s, j) in enumerate(window[:3])]
    return sorted(out)


@pytest.mark.parametrize("scale, skew, cells", [(1, False, (64, 5)), (1, True, (1 << 14, 1024)), (1 << 24, False, (100, 7))])
def test_hard_negatives_equal_brute_force(spark, monkeypatch, scale, skew, cells):
    rng = np.random.default_rng(4)
    monkeypatch.setattr(hard_negatives, "BLOCK", 40)
    centres = rng.normal(size=(4, 12))
    labels = np.where(rng.random(700) < 0.8, 0, rng.integers(0, 4, 700)) if skew else rng.integers(0, 4, 700)
    x = np.floor((centres[labels] * rng.choice([0.2, 1.0]) + rng.normal(size=(700, 12))) * 8).astype(np.int64) * scale
    x[100:140] = x[100]  # ties
    x[200:210] = 0
    rows = [(i, int(labels[i]), x[i].tolist()) for i in range(700)]
    df = spark.createDataFrame(rows, "vec_id long, label long, vector array<long>")
    got = hard_negatives.mine(df, F.col("vec_id") % 50 == 0, rows_a_cell=cells[0], anchors_a_cell=cells[1]).collect()
    assert sorted(map(tuple, got)) == brute_negatives(rows)


def test_index_leaves_out_what_norms_cover_and_loses_no_pair():
    rng = np.random.default_rng(9)
    rows, anchors = np.floor(rng.normal(size=(300, 32)) * 20 * np.linspace(3, 0.1, 32)), np.floor(rng.normal(size=(40, 32)) * 20 * np.linspace(3, 0.1, 32))
    scores = anchors @ rows.T
    for quantile in (0.5, 0.9, 0.99, 1.0):
        least = np.quantile(scores, quantile)
        index = hard_negatives.Index(rows, float(least), float(np.linalg.norm(anchors, axis=1).max()))
        at, row, found = index.search(anchors, np.full(len(anchors), least))
        assert set(zip(at, row, found, strict=True)) == {(i, j, int(scores[i, j])) for i, j in np.argwhere(scores >= least)}
    assert len(index.lists[-1][0]) < len(rows)


def test_vectors_of_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.5], 1), (1, [1.0, 0.5], 1), (1, [1.0, 0.5], 1), (2, None, 1), (3, [nan, 1.0], 1), (4, [inf, 1.0], 1), (5, [None, 1.0], 1), (6, [1.0, 1.0], None), (8, [0.7], 2), (9, [], 2), (None, [1.0, 1.0], 1)]
    df = spark.createDataFrame([(i, v, c, 1, 2, 3) for i, v, c in rows], "vec_id long, embedding array<float>, label int, score int, slot int, anchor_id int")
    kept = hard_negatives.usable(df)
    assert sorted(r["vec_id"] for r in kept.collect()) == [0, 1, 8, 9]
    assert [tuple(r) for r in hard_negatives.mine(kept, F.col("vec_id") % 50 == 0).collect()] == [(0, 1, 1, 8, 256 * 256 + 128 * 128, 256 * 179)]
    assert hard_negatives.mine(kept.limit(0), F.col("vec_id") % 50 == 0).count() == 0


# ---- alignment


def brute_alignment(texts):
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    a, b = Tokenizer.from_file(BYTES), SentencePieceProcessor(model_file=PIECES)
    a.encode_special_tokens = True
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    back = {chr(c): c for c in plain} | {chr(256 + n): c for n, c in enumerate(c for c in range(256) if c not in plain)}
    docs, counts = [], Counter()
    for t in texts:
        t = t or ""
        ids_a, ids_b = (a.encode(" " + t, add_special_tokens=False).ids, b.encode(t)) if t else ([], [])
        bytes_a = [bytes(back[c] for c in a.id_to_token(i)) for i in ids_a]
        bytes_b = [bytes([int(b.id_to_piece(i)[3:-1], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
        if b"".join(bytes_a) != b" " + t.encode() or b"".join(bytes_b) != b" " + t.encode():
            ids_a, ids_b, bytes_a, bytes_b = [], [], [], []
        at_a, at_b = ({int(e): n for n, e in enumerate(np.cumsum([len(x) for x in side]))} for side in (bytes_a, bytes_b))
        shared, groups, links, i, j = sorted(at_a.keys() & at_b.keys()), [], [], 0, 0
        for e in shared:
            groups.append(",".join(map(str, ids_a[i : at_a[e] + 1])) + "|" + ",".join(map(str, ids_b[j : at_b[e] + 1])))
            i, j = at_a[e] + 1, at_b[e] + 1
            links.append((ids_a[i - 1], ids_b[j - 1]))
        counts.update(links)
        docs.append((len(ids_a), len(ids_b), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""))
    most = Counter()
    for (_, y), n in counts.items():
        most[y] = max(most[y], n)
    return [(n_a, n_b, g, len(links), sum(counts[x] == most[x[1]] for x in links), sum(counts[x] for x in links), sha) for n_a, n_b, g, links, sha in docs]


@pytest.mark.parametrize("broadcast_pairs", [alignment.BROADCAST_PAIRS, 1])
def test_alignment_of_odd_rows_equals_brute_force(spark, odd, broadcast_pairs):
    got = alignment.aligned_documents(odd, BYTES, PIECES, 32_000, broadcast_pairs).collect()
    rows = odd.collect()
    assert Counter(map(tuple, got)) == Counter((r["doc_id"], *want) for r, want in zip(rows, brute_alignment([r["text"] for r in rows]), strict=True))
    assert alignment.aligned_documents(odd.limit(0), BYTES, PIECES, 32_000).count() == 0


def test_alignment_query_equals_brute_force(spark, monkeypatch):
    from recordloom.llm.queries import QUERIES

    rows = table(spark, FOLDER, "documents").collect()
    got = sorted(map(tuple, QUERIES["op13_cross_tokenizer_alignment"](spark, FOLDER).collect()))
    assert got == sorted((r["doc_id"], *want) for r, want in zip(rows, brute_alignment([r["text"] for r in rows]), strict=True))
