"""Vector codes and cross-tokenizer alignment against brute force."""

import hashlib
import math
import random
from collections import Counter

import numpy as np
import pytest

from meteora.llm import alignment, bpe, vector_codes
from meteora.llm.queries import tokenizer_path
from tests.llm import rows as R


def model_path():
    import public_tokenizers
    return str(public_tokenizers.path("piece_bpe_32k.model"))


# ---------------------------------------------------------------- vector codes

def coded(rows):
    """The contract, row by row, in Python's integers."""
    kept = [(i, [math.floor(4096 * x) if abs(x) < 1e300 else int(x) * 4096 for x in v], label) for i, v, label in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    by_length = {}
    for r in kept:
        by_length.setdefault(len(r[1]), []).append(r)
    out = []
    for n, group in by_length.items():
        group.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
        cuts = [p * n // 8 for p in range(9)]
        part = lambda v, p: v[cuts[p]:cuts[p + 1]]
        books = [[part(r[1], p) for r in group[:16]] for p in range(8)]
        far = lambda x, y: sum((a - b) ** 2 for a, b in zip(x, y, strict=True))
        near = lambda v, p: min((far(part(v, p), e), i) for i, e in enumerate(books[p]))  # noqa: E731, B023
        for _ in range(6):
            given = [[[] for _ in books[0]] for _ in range(8)]
            for _, v, _ in group:
                for p in range(8):
                    given[p][near(v, p)[1]].append(part(v, p))
            books = [[[sum(c) // len(g) for c in zip(*g, strict=True)] if g else e
                      for g, e in zip(given[p], books[p], strict=True)] for p in range(8)]
        sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
        for i, v, label in group:
            best = [near(v, p) for p in range(8)]
            out.append((i, "".join(f"{e:02x}" for _, e in best), sum(d for d, _ in best), label, sha))
    total = Counter()
    for _, _, e, label, _ in out:
        total[label] += e
    most = (1 << 63) - 1
    return Counter((i, c, min(e, most), min(total[label], most), s, label) for i, c, e, label, s in out)


def vectors(n, dim, seed=0):
    rng = np.random.default_rng(seed)
    return [(int(i), [float(x) for x in rng.normal(0, 0.2, dim)], [0, 1, None][i % 3]) for i in rng.permutation(n)]


AWKWARD = [(900, None, 1), (901, [float("nan")] * 16, 1), (902, [1.0, None] * 8, 1), (903, [float("inf")] * 16, None),
           (904, [], 1), (None, [0.5] * 16, 1), (3, [0.25] * 16, 7), (3, [0.25] * 16, 7), (905, [0.0] * 16, 2)]


def check_codes(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").selectExpr(
        "*", "1 AS dim", "2 AS v", "3 AS _key", "4 AS _rows", "'x' AS code", "5 AS ids")
    got = vector_codes.compress(df).collect()
    assert Counter((r.vec_id, r.code, r.error, r.label_error, r.codebooks_sha256, r.label) for r in got) == coded(rows)


@pytest.mark.parametrize("rows", [
    vectors(120, 16) + AWKWARD, vectors(40, 19) + vectors(30, 8, 1), vectors(5, 3) + [(7, [], 0)], AWKWARD[:4], [],
    [(i, [0.5 + (i % 3)] * 8, i % 2) for i in range(60)]], ids=["awkward", "lengths", "few", "none", "empty", "ties"])
def test_codes_equal_brute_force(spark, rows):
    check_codes(spark, rows)


def test_codes_of_huge_components(spark):
    rows = [(i, [x * 10.0 ** (i % 7 * 40) for x in v], g) for i, v, g in vectors(40, 8)]
    check_codes(spark, rows + [(99, [1e308, -1e308] * 4, 1)])


def test_codes_in_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(vector_codes, "BLOCK", 7)
    check_codes(spark, vectors(60, 16))


# ------------------------------------------------------------------- alignment

def tokens(text):
    """(ids, end offsets) of both sides for blank + text, or None."""
    import json

    import sentencepiece
    from tokenizers import Tokenizer
    a_side = Tokenizer.from_file(tokenizer_path())
    a_side.encode_special_tokens = True
    letters = bpe.byte_letters()
    with open(tokenizer_path(), encoding="utf-8") as f:
        spell = {i: bytes(letters[c] for c in t) for t, i in json.load(f)["model"]["vocab"].items()
                 if all(c in letters for c in t)}
    model = sentencepiece.SentencePieceProcessor(model_file=model_path())

    def piece(i):
        p = model.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if model.is_byte(i) else p.replace("▁", " ").encode()

    def both(text):
        if not text:
            return None
        a = a_side.encode(" " + text, add_special_tokens=False).ids
        b = model.encode(text)
        x, y = [spell[i] for i in a], [piece(i) for i in b]
        if b"".join(x) != (" " + text).encode() or b"".join(y) != (" " + text).encode():
            return None
        return a, np.cumsum([len(i) for i in x]).tolist(), b, np.cumsum([len(i) for i in y]).tolist()
    return [both(t) for t in text]


def aligned(data):
    found = tokens([d[1] for d in data])
    groups, links = [], []
    for f in found:
        if f is None:
            groups.append([])
            links.append([])
            continue
        a, ea, b, eb = f
        common = sorted(set(ea) & set(eb))
        cut = [(lo, hi) for lo, hi in zip([0, *common], common)]
        groups.append([([i for i, e in zip(a, ea) if lo < e <= hi], [i for i, e in zip(b, eb) if lo < e <= hi])
                       for lo, hi in cut])
        links.append([(i, j) for i, e in zip(a, ea) for j, k in zip(b, eb) if e == k] if len(a) < 3000
                     else [(g[0][-1], g[1][-1]) for g in groups[-1]])
    count = Counter(p for x in links for p in x)
    best = {}
    for (_, j), n in count.items():
        best[j] = max(n, best.get(j, 0))
    out = []
    for d, f, g, x in zip(data, found, groups, links):
        text = ";".join(",".join(map(str, p)) + "|" + ",".join(map(str, q)) for p, q in g)
        out.append((d[0], len(f[0]) if f else 0, len(f[2]) if f else 0, len(g), len(x),
                    sum(count[p] == best[p[1]] for p in x), sum(count[p] for p in x),
                    hashlib.sha256(text.encode()).hexdigest() if f else ""))
    return Counter(out)


def odd_texts():
    rng = random.Random(4)
    parts = ["a", " ", "  ", "\n", "'s", "'", "é", "22", "!!", " \n ", " word", "日本", "<|endoftext|>", "<s>", "<0x0A>",
             " ", " ", "\t", "x" * 30, "😀", " ", "́"]
    texts = ["".join(rng.choices(parts, k=rng.choice([1, 3, 40, 300]))) for _ in range(40)]
    return texts + [" ", "  ", "a ", " a", "a▁b", "▁", "\n", "one  two ", "z" * 500, "a  b " * 60]


@pytest.mark.parametrize("each,most", [(1 << 16, 1 << 20), (64, 5), (7, 0)])
def test_alignment_equals_brute_force(spark, each, most):
    data = R.awkward() + [(300 + i, t, "en", "a", 1) for i, t in enumerate(odd_texts())]
    df = R.docs(spark, data).selectExpr("*", "1 AS row", "2 AS k", "3 AS pair", "4 AS best", "5 AS pairs")
    got = alignment.align(df, tokenizer_path(), model_path(), each, most).collect()
    assert Counter(tuple(r) for r in got) == aligned(data)


def test_alignment_of_an_empty_table(spark):
    assert alignment.align(R.empty(spark), tokenizer_path(), model_path()).count() == 0


def test_fragments_are_a_monoid():
    vocab = alignment.vocabularies(tokenizer_path(), model_path())
    rng = random.Random(1)
    texts = odd_texts()[:20] + [R.prose(8, 60)]
    for text, f in zip(texts, tokens(texts)):
        if f is None:
            continue
        a, ea, b, eb = (np.array(x) for x in f)
        total = int(ea[-1])
        cuts = sorted(rng.sample(range(total + 1), min(total, 9)))
        spans = list(zip([0, *cuts], [*cuts, total]))
        parts = []
        for lo, hi in spans:
            x, y = (ea > lo) & (ea <= hi), (eb > lo) & (eb <= hi)
            parts.append(alignment.fragment(a[x].astype(np.uint32), ea[x], b[y].astype(np.uint32), eb[y], vocab))
        whole = alignment.finish(alignment.fragment(a.astype(np.uint32), ea, b.astype(np.uint32), eb, vocab), vocab)
        for _ in range(3):  # any bracketing
            rest = [alignment.Fragment(), *parts, alignment.Fragment()]
            while len(rest) > 1:
                i = rng.randrange(len(rest) - 1)
                rest[i:i + 2] = [alignment.compose(rest[i], rest[i + 1], vocab)]
            groups, links = alignment.finish(rest[0], vocab)
            assert groups == whole[0] and (links == whole[1]).all()


def test_ranges_cover_a_text_once():
    for text in [" " + t for t in odd_texts()]:
        data = text.encode()
        for each in (3, 16, 1000):
            found = list(alignment.ranges(len(data), alignment.safe_cuts(text), each))
            assert [lo for lo, *_ in found] == [0, *[hi for _, hi, *_ in found[:-1]]] and found[-1][1] == len(data)
            assert all(start <= lo < hi <= stop for lo, hi, start, stop in found)
            assert sum(stop - start for *_, start, stop in found) <= 3 * len(data) + 2 * each * len(found)
