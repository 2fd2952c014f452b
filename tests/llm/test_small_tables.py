"""Brute-force comparisons over small tables with awkward rows."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from meteora.llm import ann, chat, line_dedup, mixing, ngram_join, packing, quality, suffix_dedup, token_counts
from meteora.llm.queries import tokenizer_path
from tests.llm import rows as R

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def key(x):
    return tuple((v is None, v) for v in x)


def shingles(text, k):
    w = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def linked(data, k, num, den):
    sets = [shingles(t, k) for _, t, *_ in data]
    label = list(range(len(data)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i
    for i in range(len(data)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and den * both >= num * len(sets[i] | sets[j]):
                label[root(i)] = root(j)
    group = {}
    for i in range(len(data)):
        group.setdefault(root(i), []).append(i)
    out = []
    for members in group.values():
        ids = [data[i][0] for i in members if data[i][0] is not None]
        out += [(data[i][0], len(sets[i]), min(ids) if ids else None) for i in members]
    return sorted(out, key=key)


def family(n, words=60):
    """Near copies: a core, light edits of it, and copies of a passage."""
    rng = np.random.default_rng(5)
    core = R.prose(9, words).split()
    data = []
    for i in range(n):
        w = list(core)
        for p in rng.integers(0, words, i % 7):
            w[p] = f"edit{i}x{p}"
        data.append((i, " ".join(w), "en", "a", 1))
    passage = " ".join(R.prose(11, 30).split())
    data += [(n + i, R.prose(100 + i, 40) + " " + passage, "en", "b", 1) for i in range(12)]
    return data


@pytest.mark.parametrize("k,num,den,rare", [(3, 90, 100, 20), (5, 80, 100, 3), (3, 90, 100, 1)])
def test_ngram_join_equals_all_pairs(spark, k, num, den, rare):
    data = R.awkward() + [(100 + r[0], *r[1:]) for r in family(40)]
    got = ngram_join.ngram_join(R.docs(spark, data), k, num, den, rare)
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got.collect()), key=key) == linked(data, k, num, den)


def test_ngram_join_raises_rare_class_when_the_list_is_full(spark):
    data = family(40)
    got = ngram_join.ngram_join(R.docs(spark, data), 3, 90, 100, rare=1, most=5)
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got.collect()) == linked(data, 3, 90, 100)


def test_ngram_join_does_not_pair_all_copies_when_the_list_is_full(spark, monkeypatch):
    rng, core = np.random.default_rng(7), R.prose(5, 150).split()
    data = []
    for i in range(300):  # near copies with an edit of their own
        w = list(core)
        w[int(rng.integers(0, 150))] = f"own{i}"
        data.append((i, " ".join(w), "en", "a", 1))
    seen, write = Counter(), ngram_join.scratch

    def counted(df, what):
        out = write(df, what)
        if what in ("pairs", "cross"):
            seen[what] += out.count()
        return out

    monkeypatch.setattr(ngram_join, "scratch", counted)
    for most in (1 << 20, 5):
        seen.clear()
        got = ngram_join.ngram_join(R.docs(spark, data), 3, 90, 100, most=most).collect()
        assert {r.component_id for r in got} == {0}
        assert sum(seen.values()) < 3000, seen  # of 44,850


@pytest.mark.parametrize("num,n", [(80, 63), (80, 64), (80, 70), (80, 400), (90, 66), (90, 300)])
def test_combinations_hold_a_common_run(num, n):
    """Every pair that may link and shares no rare token shares a run."""
    rng = np.random.default_rng(n)
    for _ in range(60):
        t = ngram_join.misses(n, num, 100)
        u = int(rng.integers(0, t + 1))
        v = int(rng.integers(0, 100 * (n - u) // num - n + 1))
        both = rng.integers(0, 1 << 63, n - u, dtype=np.uint64)
        x, y = (np.unique(np.r_[both, rng.integers(0, 1 << 63, m, dtype=np.uint64)]) for m in (u, v))
        found = [{(k, h) for k in ngram_join.combination_lengths(len(s), num, 100)
                  for h in ngram_join.runs(s[:ngram_join.prefix_length(len(s), 0, num, 100, k)], k).tolist()}
                 for s in (x, y)]
        assert found[0] & found[1]


def test_ngram_join_empty_and_one_of_each(spark):
    assert ngram_join.ngram_join(R.empty(spark)).count() == 0
    kept = ngram_join.one_of_each(R.docs(spark), 5, 80, 100)
    want = {c for _, _, c in linked(R.awkward(), 5, 80, 100)} | {3, 4, 5}
    assert {r.doc_id for r in kept.collect()} == want
    assert kept.columns == R.docs(spark).columns
    assert all(r._hash == 1 for r in kept.collect())


def test_sketch_never_hides_a_link():
    rng = np.random.default_rng(0)
    for n in (1, 5, 70, 900):
        a = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
        b = np.unique(np.concatenate([a[: n - n // 10], rng.integers(0, 1 << 63, n // 9 + 1, dtype=np.uint64)]))
        p, q = (np.frombuffer(ngram_join.parity(x), np.uint8) for x in (a, b))
        size = min(len(p), len(q))
        apart = np.bitwise_count(ngram_join._fold(p, size) ^ ngram_join._fold(q, size)).sum()
        assert apart <= len(np.setxor1d(a, b))


def repeats(data, length):
    seen = Counter()
    raw = [(d[0], (d[1] or "").encode()) for d in data]
    for _, b in raw:
        seen.update(b[p:p + length] for p in range(len(b) - length + 1))
    out = []
    for i, b in raw:
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if seen[b[p:p + length]] > 1:
                gone[p:p + length] = b"\1" * length
        spans = sum(1 for j in range(len(gone)) if gone[j] and (not j or not gone[j - 1]))
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=key)


@pytest.mark.parametrize("length,gram", [(200, 32), (40, 8), (24, 24)])
def test_suffix_dedup_equals_every_window(spark, length, gram):
    data = R.awkward() + [(50 + r[0], *r[1:]) for r in family(12)]
    data.append((90, "ab" * 150 + R.prose(30, 20), "en", "a", 1))  # repeats itself
    got = suffix_dedup.suffix_dedup(R.docs(spark, data), length, gram)
    assert sorted((tuple(r) for r in got.collect()), key=key) == repeats(data, length)
    if length == 200:
        assert suffix_dedup.suffix_dedup(R.empty(spark)).count() == 0
    if length == 40:  # texts that share their bits stay apart
        got = suffix_dedup.suffix_dedup(R.docs(spark, data), length, gram, node_bits=2)
        assert sorted((tuple(r) for r in got.collect()), key=key) == repeats(data, length)


def lines_left(df, *how):
    """doc_id, text left, lines, lines gone."""
    return [(r.row.doc_id, r.text, r.lines, r.gone, r.row) for r in line_dedup.judged(df, *how).collect()]


def test_line_dedup_keeps_first_of_each_chunk(spark):
    shared = [f"shared line {i} of a passage" for i in range(16)]
    data = R.awkward() + [(20 + i, "\n".join([f"own {i} {j}" for j in range(i)] + shared + [f"tail {i}"]), "en", "a", 1)
                          for i in range(4)]
    got = lines_left(R.docs(spark, data))
    assert len(got) == len(data)
    by, texts = {}, {d[0]: d[1] for d in data}
    for r in got:
        by.setdefault(r[0], r)
    assert by[20][1] == texts[20]  # the first keeps all
    for i in range(21, 24):
        assert by[i][3] == 16 and by[i][1] == "\n".join(x for x in texts[i].split("\n") if not x.startswith("shared"))
    assert all(r[4]._hash == 1 for r in got)  # a column of the table, not an inner one
    assert by[3][1] is None and by[4][1] == "" and by[9][3] == 0
    assert line_dedup.dedup(R.empty(spark)).count() == 0
    kept = line_dedup.dedup(R.docs(spark, data))
    assert kept.columns == R.docs(spark, data).columns
    assert {r.doc_id for r in kept.collect()} == set(texts) - {1, 12}  # whole copies go


def without_repeats(data, long=line_dedup.LONG, least=line_dedup.LEAST):
    """Texts without the passages that have an earlier place."""
    where = {}
    order = sorted({(d[0], d[1]) for d in data if d[1]})
    for k, (_, text) in enumerate(order):
        lines = text.split("\n")
        for i, x in enumerate(lines):
            for chunk in ([tuple(lines[i:i + 2])] if i + 1 < len(lines) else []) + (
                    [(x,)] if len(x) >= long or lines == [x] and x.strip() else []):
                where.setdefault(chunk, []).append((k, i))
    marked = {(k, i + j) for chunk, places in where.items() for k, i in places[1:] for j in range(len(chunk))}
    out = {}
    for k, d in enumerate(order):
        lines, gone, i = d[1].split("\n"), set(), 0
        while i < len(lines):
            j = i
            while j < len(lines) and (k, j) in marked:
                j += 1
            if j > i and (j - i == len(lines) or len(WORD.findall("\n".join(lines[i:j]))) >= least):
                gone |= set(range(i, j))
            i = max(j, i + 1)
        out[d] = "\n".join(x for i, x in enumerate(lines) if i not in gone)
    return out


@pytest.mark.parametrize("n", range(2, 9))
def test_line_dedup_finds_every_short_passage(spark, n):
    data = []
    for p in range(20):  # each passage inside three documents, at other places
        passage = [f"passage {n} {p} line {j} with words enough for prose to be" for j in range(n)]
        data += [(3 * p + c, "\n".join([f"head {p} {c} {j}" for j in range(1 + (p + c) % 4)] + passage + [f"tail {p} {c}"]),
                  "en", "a", 1) for c in range(3)]
    got = {r[0]: r for r in lines_left(R.docs(spark, data))}
    for d in data:
        assert got[d[0]][3] == (n if d[0] % 3 else 0)
        assert got[d[0]][1] == "\n".join(x for x in d[1].split("\n") if not d[0] % 3 or not x.startswith("passage"))


@pytest.mark.parametrize("least", [0, 5, 20])
def test_line_dedup_equals_brute_force(spark, least):
    rng = np.random.default_rng(8)
    lines = [f"line {i}" for i in range(12)] + ["", "long " * 50]
    data = [(i, "\n".join(lines[k] for k in rng.integers(0, len(lines), rng.integers(1, 14))), "en", "a", 1)
            for i in range(60)] + [(100, "a\na\na\na\nb", "en", "a", 1), (101, "b\n" + "long " * 50 + "\nc", "en", "a", 1)]
    want = without_repeats(data, least=least)
    for doc, left, n, gone, row in lines_left(R.docs(spark, data), line_dedup.LONG, least):
        assert left == want.get((doc, row.text), row.text)
        assert gone == 0 or n - gone == (len(left.split("\n")) if n > gone else 0)


def test_line_dedup_of_long_passages_equals_brute_force(spark):
    rng = np.random.default_rng(18)
    base = [f"line {i} of the base" for i in range(90)]
    data = []
    for i in range(40):  # stretches of the base at other places, own lines between
        lines = []
        for j in range(rng.integers(1, 4)):
            at = rng.integers(0, 80)
            lines += [f"own {i} {j}"] * int(rng.integers(0, 3)) + base[at:at + rng.integers(1, 60)]
        data.append((i, "\n".join(lines), "en", "a", 1))
    data += [(50, "\n".join(base), "en", "a", 1), (51, "\n".join(base * 3), "en", "a", 1)]
    want = without_repeats(data)
    for doc, left, _, _, row in lines_left(R.docs(spark, data)):
        assert left == want.get((doc, row.text), row.text)


def test_line_dedup_boundaries_move_with_the_lines(spark):
    from pyspark.sql import functions as F
    base = [f"line {i} of the base" for i in range(400)]
    texts = {"as it is": base, "shifted": ["new"] * 7 + base, "cut": base[11:]}
    rows = spark.createDataFrame([(k, v) for k, v in texts.items()], "name string, lines array<string>")
    for mean in (4, 16):
        found = {}
        for r in rows.select("name", line_dedup.coarse(F.col("lines"), (mean,)).alias("c")).collect():
            spans = sorted((c.code >> 32, c.code & 0xFFFFFFFF) for c in r.c)
            assert all(a + n <= b for (a, n), (b, _) in zip(spans, spans[1:])) and all(n > 2 for _, n in spans)
            found[r.name] = {"\n".join(texts[r.name][a:a + n]) for a, n in spans}
        assert 400 / mean / 4 < len(found["as it is"]) < 400 / mean * 2
        for other in ("shifted", "cut"):  # all but those at the changed place
            assert len(found["as it is"] ^ found[other]) <= 2 + (11 // 3 if other == "cut" else 3)


def test_line_dedup_sends_a_long_copy_once(spark):
    lines = [f"line {i} of the base" for i in range(300)]
    data = R.docs(spark, [(i, "\n".join(lines), "en", "a", 1) for i in (1, 2)])
    large = line_dedup._later(data, line_dedup._repeated(data, line_dedup.coarse)).collect()
    assert [r.doc_id for r in large] == [2]
    covered = {k for c in large[0].gone for k in range(c >> 32, (c >> 32) + (c & 0xFFFFFFFF))}
    assert len(covered) > 280 and len(large[0].gone) < 120


def test_line_dedup_leaves_blank_lines_and_markup(spark):
    code = ["import os\n\n\ndef f(x):\n    return x\n\n\nprint(f(1))\n", "import re\n\n\nclass A:\n    pass\n\n\nA()\n"]
    lists = [f"<div>\n<ul>\n<li>{x}</li>\n</ul>\n</div>\n<p>own {x}</p>" for x in "ab"]
    data = [(i, t, "en", "a", 1) for i, t in enumerate(code + lists)]
    assert [(d, left) for d, left, *_ in sorted(lines_left(R.docs(spark, data)))] == [d[:2] for d in data]


def test_line_dedup_takes_whole_copies(spark):
    texts = ["\n".join(f"text {t} line {j}" for j in range(1 + t % 9)) for t in range(30)] + ["  "]
    data = [(100 * c + t, x, "en", "a", 1) for c in range(3) for t, x in enumerate(texts)]
    for doc, left, n, gone, _ in lines_left(R.docs(spark, data)):
        blank = doc % 100 == 30
        assert left == (texts[doc % 100] if doc < 100 or blank else "")
        assert gone == (0 if doc < 100 or blank else n)


def test_packing_round_trip(spark):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(tokenizer_path())  # untouched
    data = [(190 + i, t, "en", "a", 1) for i, t in enumerate([
        "a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|><|endoftext|> \n", "<|endo", "ftext|>", "it's<|endoftext|>'s"])]
    data += R.awkward() + [(200 + i, R.prose(60 + i, 30 + 37 * i % 500), "en", "a", 1) for i in range(60)]
    got = packing.pack_documents(R.docs(spark, data), tokenizer_path()).collect()
    want = Counter()
    for d in data:
        ids = np.array(tok.encode(d[1] or "", add_special_tokens=False).ids + [0], "<u4")
        cuts = [0, *range(len(ids) % 2048 or 2048, len(ids) + 1, 2048)]
        want.update((d[0], k, a, b - a, zlib.crc32(ids[a:b].tobytes())) for k, (a, b) in enumerate(zip(cuts, cuts[1:])))
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    bins = {}
    for r in got:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in bins.values():
        parts.sort()
        assert [o for o, _ in parts] == [sum(n for _, n in parts[:i]) for i in range(len(parts))]
        assert sum(n for _, n in parts) <= 2048
    assert len(bins) <= -(-sum(r.length for r in got) // 2048) + 1
    assert packing.pack_documents(R.empty(spark), tokenizer_path()).count() == 0


def test_packing_in_levels(spark):
    rows = [(i, 0, 0, 1 + (i * 7919) % 2048, i) for i in range(900)]
    pieces = spark.createDataFrame(rows, packing.PIECES)
    got = packing.pack(pieces, shard=64).collect()
    assert sorted(r.doc_id for r in got) == list(range(900))
    fill = Counter()
    for r in got:
        fill[r.sequence_id] += r.length
    assert max(fill.values()) <= 2048
    least = max(sum(r[3] for r in rows) / 2048, sum(r[3] > 1024 for r in rows))  # two halves don't share a bin
    assert len(fill) <= 1.08 * least + 1  # with shards of 64 pieces only


@pytest.mark.parametrize("lengths", [
    [1100 + (i * 7919) % 800 for i in range(600)],  # no two share a bin, none is filled well
    [1100 + (i * 7919) % 800 for i in range(400)] + [1 + i % 40 for i in range(200)],
    [1] * 600])
def test_packing_holds_no_more_than_a_shard(spark, monkeypatch, lengths):
    # a row of the search is a shard: its size is written to the islands table
    seen, write = [], packing.scratch

    def watched(df, what):
        out = write(df, what)
        if what == "islands":
            seen.append(out.selectExpr("max(size(lengths))").first()[0])
        return out

    monkeypatch.setattr(packing, "scratch", watched)
    pieces = spark.createDataFrame([(i, 0, 0, n, i) for i, n in enumerate(lengths)], packing.PIECES)
    got = packing.pack(pieces, shard=64).collect()
    assert sorted((r.doc_id, r.length) for r in got) == list(enumerate(lengths))
    fill = Counter()
    for r in got:
        fill[r.sequence_id] += r.length
    assert max(fill.values()) <= 2048
    assert max(seen) <= 128
    halves = sum(n > 1024 for n in lengths)
    assert len(fill) <= max(halves, sum(lengths) / 2048) + len(lengths) / 64 + 1  # one open bin a shard


def test_edited_counts_equal_a_fresh_count():
    import random

    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(tokenizer_path())
    tok.encode_special_tokens = True
    encoder, rng = token_counts.Encoder(tokenizer_path()), random.Random(3)
    parts = ["a", " ", "  ", "\n", "'s", "'re", "'", "é", "22", "!!", " \n ", " word", "日", "<|endoftext|>"]
    for text in [R.prose(3, 400), "", "x'", " a b  c\n\n d", R.awkward()[10][1]]:
        tree = token_counts.TokenTree(text, encoder)
        for _ in range(20):
            a = rng.randint(0, len(text))
            b = min(len(text), a + rng.choice([0, 1, 5, 60, 700]))
            new = "".join(rng.choices(parts, k=rng.choice([0, 1, 4])))
            tree.replace(a, b, new)
            text = text[:a] + new + text[b:]
            assert tree.text() == text and tree.total == len(tok.encode(text, add_special_tokens=False).ids)


def test_token_counts_table(spark):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(tokenizer_path())
    tok.encode_special_tokens = True
    n = lambda t: len(tok.encode(t, add_special_tokens=False).ids)
    data = R.awkward() + [(70, "same line\nmail me@site.org or 10.0.0.1\nsame line\nend", "en", "a", 1)]
    got = token_counts.count_edits(R.docs(spark, data), tokenizer_path()).collect()
    assert Counter((r.doc_id, r.n_tokens) for r in got) == Counter((d[0], n(d[1] or "")) for d in data)
    row = next(r for r in got if r.doc_id == 70)
    assert (row.n_edits, row.n_tokens_after) == (3, n("same line\nmail [mail] or [address]\nend"))
    assert token_counts.count_edits(R.empty(spark), tokenizer_path()).count() == 0


def test_token_trees_are_kept_and_edited_in_batches(spark, tmp_path):
    import random

    from pyspark.sql import functions as F
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(tokenizer_path())
    tok.encode_special_tokens = True
    n = lambda t: len(tok.encode(t or "", add_special_tokens=False).ids)
    folder, rng = str(tmp_path / "trees"), random.Random(11)
    data = R.awkward() + [(9, "another text of an id", "en", "a", 1)]
    token_counts.store(token_counts.trees(R.docs(spark, data), tokenizer_path()), folder, 8)
    texts = Counter((d[0], d[1]) for d in data)
    for batch in range(3):
        kept = spark.read.parquet(folder).select("doc_id", "text", "text_hash").collect()
        chosen = {(r.doc_id, r.text): r.text_hash for r in kept if r.doc_id in (0, 4, 9, None) and batch < 2 or r.doc_id == 9}
        rows, want = [], {}
        for (doc, text), code in chosen.items():
            text, after, at, last = text or "", "", 0, 0
            for _ in range(3):
                a = rng.randint(last, len(text))
                b = min(len(text), a + rng.choice([0, 3, 200]))
                if a < b or a > last or not rows:
                    new = rng.choice(["", "new words ", "'s é\n"])
                    rows.append((doc, code, a, b, new))
                    after, at, last = after + text[at:a] + new, b, b + 1
                if last > len(text):
                    break
            want[doc, text] = after + text[at:]
        edits = spark.createDataFrame(rows + rows[:1], "doc_id long, text_hash long, start long, stop long, text string")
        before = {str(f): f.stat().st_mtime_ns for f in (tmp_path / "trees").rglob("*.parquet")}
        got = token_counts.edit_table(edits, folder, tokenizer_path(), 8).collect()
        texts = Counter({(d, want.get((d, t), t)): 0 for d, t in texts}) + Counter(
            x for (d, t), k in texts.items() for x in [(d, want.get((d, t), t))] * k)
        after = spark.read.parquet(folder).collect()
        assert Counter((r.doc_id, r.text) for r in after) == texts
        for r in after:
            assert r.tokens[1] == n(r.text) == sum(r.counts) and sum(r.lens) == len(r.text or "") == r.chars[1]
        for r in got:
            assert r.n_edits > 0 and any(n(t) == r.n_tokens_after and n(old) == r.n_tokens
                                         for (d, old), t in want.items() if d == r.doc_id)
        if batch == 2:  # one id: one bucket is written anew, and little of the long text is encoded
            now = {str(f) for f in (tmp_path / "trees").rglob("*.parquet")}
            assert len({f.split("bucket=")[1].split("/")[0] for f in now - set(before)}) == 1
        again = token_counts.edit_table(edits.where(F.col("start") < F.col("stop")), folder, tokenizer_path(), 8)
        assert again.count() == 0  # the texts that it means are gone
    assert max(r.n_reencoded for r in got) < 1500 < max(len(r.lens) for r in after)


def test_quality_counts_equal_brute_force(spark):
    data = R.awkward() + [(80, "a b c d e f\na b c d e f\n## $5 | x", "en", "a", 1)]
    labels = spark.createDataFrame([(0, 1, 0), (9, 1, 0), (9, 1, 0), (None, 1, 0), (1, None, None)],
                                   "doc_id long, quality int, toxic int")
    got = quality.quality(R.docs(spark, data), labels).collect()
    want = Counter()
    for d in data:
        t = d[1] or ""
        w = WORD.findall(t)
        grams = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
        often = Counter(grams)
        cover = {j for i, g in enumerate(grams) if often[g] > 1 for j in range(i, i + 5)}
        lines = [x for x in t.split("\n") if WORD.search(x)]
        want[(d[0], len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)),
              len(cover), len(w) < 10 or 100 * len(cover) > 20 * len(w))] += 1
    assert Counter(tuple(r)[:7] for r in got) == want
    assert all(not r.kept for r in got if r.base_failed)
    kept = quality.keep_good(R.docs(spark, data), labels)
    assert kept.columns == R.docs(spark, data).columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter(r.doc_id for r in got if r.kept)
    assert quality.quality(R.empty(spark), labels).count() == 0
    assert {r.llr for r in quality.quality(R.docs(spark, data), labels.limit(0)).collect()} == {0.0}


def test_quality_on_held_out_labels(spark):
    """Fitted on the even ids, judged on the odd ones."""
    d = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    got = quality.quality(docs, labels.where("doc_id % 2 = 0")).join(labels.where("doc_id % 2 = 1"), "doc_id") \
        .where("NOT base_failed")
    r = got.selectExpr("avg(CAST(kept = (quality = 1) AS INT)) AS right", "count(*) AS n").first()
    assert r.n > 50 and r.right > 0.98


def test_mix_targets_and_reruns(spark):
    data = R.awkward() + [(300 + i, R.prose(i, 20 + i % 60), "en", f"s{i % 5}", 1) for i in range(400)]
    got = [tuple(r) for r in mixing.mix(R.docs(spark, data)).collect()]
    assert len(got) == len(data)
    assert sorted(got, key=key) == sorted((tuple(r) for r in mixing.mix(R.docs(spark, data).repartition(7)).collect()), key=key)
    size = Counter()
    for d in data:
        size[d[3]] += len(WORD.findall(d[1] or ""))
    names = sorted(x for x in size if x is not None) + [None]
    weight = {x: (3, 1, 2)[i % 3] for i, x in enumerate(names)}
    target, free, budget = {}, set(names), 1.5 * sum(size.values())
    while True:
        left = budget - sum(target.values())
        over = {x for x in free if left * weight[x] / sum(weight[y] for y in free) > 2 * size[x]}
        if not over:
            break
        for x in over:
            target[x] = 2.0 * size[x]
        free -= over
    target |= {x: left * weight[x] / sum(weight[y] for y in free) for x in free}
    source = {d[0]: d[3] for d in data}
    taken, longest = Counter(), Counter()
    for doc, n, s, t, k, _ in got:
        assert s == size[source[doc]] and abs(t - target[source[doc]]) < 1e-6 and 0 <= k <= 2 * n
        taken[source[doc]] += k
        longest[source[doc]] = max(longest[source[doc]], n)
    assert all(abs(taken[x] - target[x]) <= longest[x] / 2 + 1e-6 for x in names)
    assert mixing.mix(R.empty(spark)).count() == 0


def test_mix_draws_in_proportion_to_size(spark):
    """Rates against a plain search for the certain sizes, draws against a plain Pareto order."""
    data = [(i, " ".join(["w"] * (1 + i * i % 97 + 4000 * (i % 250 == 0))), "en", ("a", "b", "c")[i % 3], 1) for i in range(3000)]
    data += [(None, f"no id {i}", "en", "a", 1) for i in range(300)]
    got = mixing.mix(R.docs(spark, data)).collect()
    assert len(got) == len(data)
    drawn = Counter()
    for source in "abc":
        size = {d[0]: len(WORD.findall(d[1])) for d in data if d[3] == source and d[0] is not None}
        free = [3] * (300 if source == "a" else 0)
        mine = [r for r in got if r.source_size == sum(size.values()) + sum(free)]
        whole, rest = divmod(mine[0].target, mine[0].source_size)
        if not rest:
            assert all(r.taken == 2 * r.size for r in mine)
            continue
        sizes, k = sorted([*size.values(), *free], reverse=True), 0
        while (rest - sum(sizes[:k])) / sum(s * s for s in sizes[k:]) * sizes[k] >= 1:
            k += 1
        rate = (rest - sum(sizes[:k])) / sum(s * s for s in sizes[k:])
        assert abs(sum(min(1, rate * s) * s for s in sizes) - rest) < 1e-6
        extra = {r.doc_id: r.taken > whole * r.size for r in mine if r.doc_id is not None}
        order = {}
        for i, s in size.items():
            u = (int(hashlib.md5(f"{mixing.SEED}:{i}".encode()).hexdigest()[:13], 16) + 0.5) / (1 << 52)
            p = rate * s
            order[i] = 0.0 if p >= 1 else u / (1 - u) / (p / (1 - p))
        last = max(order[i] for i in extra if extra[i])
        assert all(extra[i] == (order[i] <= last) for i in size)
        drawn.update((size[i] > 48, extra[i]) for i in size)
    assert drawn[True, True] / drawn[True, False] > 1.5 * drawn[False, True] / drawn[False, False]


def test_chat_round_trip(spark):
    probe = [r"\### Assistant: </turn> ok", "<turn>", "a: b", "\\b\\l", "", None, "### user: x", "日本\n語"]
    rows = [(1, i, ["user", "user", "assistant", "assistant"][i % 4], t) for i, t in enumerate(probe)]
    rows += [(2, 0, None, "x"), (2, None, "a:b<#", "y"), (None, 1, "user", None), (3, 5, "user", "t"), (3, 5, "user", "t")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 AS turns")
    out = chat.format_chat(df)
    back = {r.conv_id: r for r in chat.read_back(out).collect()}
    for c in (1, 2, 3, None):
        mine = sorted((r for r in rows if r[0] == c), key=lambda r: tuple((v is not None, v) for v in (r[1], r[2], r[3])))
        want = [(r[2] or "", r[3] or "") for r in mine]
        assert [(t.role, t.text) for t in back[c].turns] == want
        assert back[c].loss == "".join(t for role, t in want if role == "assistant")
    text = next(r for r in out.collect() if r.conv_id == 1).formatted
    assert text.count("</turn>\n") == 4 and text.count("### user: ") == 2  # neighbours of one role merged
    assert chat.format_chat(df.limit(0)).count() == 0


@pytest.mark.parametrize("block", [1 << 18, 64])
def test_nearest_neighbours_are_exact(spark, block):
    rng = np.random.default_rng(2)
    vs = [(i, [float(np.float32(x)) for x in rng.normal(size=8)]) for i in range(150)]
    vs += [(200 + i, vs[3][1]) for i in range(40)] + [vs[5]]
    odd = [(400, None), (401, [0.0] * 8), (402, [1.0, None] * 4), (403, [float("nan")] * 8), (404, [float("inf")] * 8),
           (405, []), (406, [1.0, 2.0]), (None, vs[0][1]), (420, [2.0, 1.0])]
    df = spark.createDataFrame(vs + odd, "vec_id long, embedding array<float>").selectExpr("*", "1 AS dim", "2 AS block")
    got = {}
    for r in ann.search(df, ann.F.pmod("vec_id", ann.F.lit(20)) == 0, 20, block).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    good = dict(vs) | {406: odd[6][1], 420: odd[8][1]}
    for q in (x for x in good if x % 20 == 0):
        best = []
        for c, v in good.items():
            if c != q and len(v) == len(good[q]):
                s = 0.0
                for a, b in zip(good[q], v, strict=True):
                    s += a * b
                best.append((-s, c))
        assert sorted(got[q]) == [(i + 1, c, -s) for i, (s, c) in enumerate(sorted(best)[:20])]
    assert set(got) == {x for x in good if x % 20 == 0}
    assert ann.search(df.limit(0), ann.F.lit(True)).count() == 0


def test_quality_score_equals_brute_force(spark, monkeypatch):
    """The score from counts, written again; hashes are read from Spark."""
    import math
    F, rng = quality.F, np.random.default_rng(3)
    letters = list("abcdefghijklmnopqrstuvwxyz")
    junk = [(1000 + i, " ".join("".join(rng.choice(letters, rng.integers(2, 9))) for _ in range(60)) + ".", "en", "a", 1)
            for i in range(50)]
    good = [(i, R.prose(i, 80), "en", "a", 1) for i in range(300)]
    data = R.awkward()[2:] + good + junk
    df = R.docs(spark, data)
    labels = spark.createDataFrame([(i, 1) for i in range(20, 300, 2)] + [(0, 1), (1000, 0), (None, 1), (5, None)],
                                   "doc_id long, quality int")
    weights, low = quality.fit(df, labels)
    half = {r.doc_id for r in quality.labelled(labels, 0, quality.TRUSTED).collect()}
    other = {r.doc_id for r in quality.labelled(labels, 1, quality.HELD_OUT).collect()}
    assert half | other == {*range(20, 300, 2), 0} and not half & other
    flat = str.lower
    grams = {}
    for r in df.select("doc_id", "text", quality.ngram_buckets(quality.word_hashes(F.col("text"))).alias("b")).collect():
        w = WORD.findall(flat(r.text or ""))
        assert len(r.b) == max(2 * len(w) - 1, 0)
        grams.setdefault((r.doc_id, r.text), []).append(list(r.b))
    raw, trust = Counter(), Counter()
    for (doc, _), many in grams.items():
        for b in many:
            raw.update(b)
            trust.update(b if doc in half else ())
    R_, G = raw.total(), trust.total()
    mean = lambda b: sum(round(math.log((trust[x] * R_ / G + 0.1) / (raw[x] + 0.1)), 3) for x in b) / len(b) if b else 0.0
    held = sorted(mean(b) for (doc, t), many in grams.items() for b in many if doc in other and len(WORD.findall(t)) >= 10)
    at = 0.01 * (len(held) - 1)
    want = held[int(at)] + (at - int(at)) * (held[int(at) + 1] - held[int(at)])
    assert abs(low - want) < 1e-9
    got = quality.quality(df, labels).collect()
    assert len(got) == len(data)
    for r in got:
        texts = [t for d, t in grams if d == r.doc_id]
        if len(texts) == 1:
            assert abs(r.llr - mean(grams[r.doc_id, texts[0]][0])) < 1e-9
            assert r.kept == (not r.base_failed and r.llr >= low)
    kept = {r.doc_id for r in got if r.kept}
    assert not kept & {d[0] for d in junk}  # random letters go
    assert len(kept & set(range(300))) >= 290
    assert quality.keep_good(df, labels).count() == sum(r.kept for r in got)
    assert quality.quality(df, labels.limit(0)).where("NOT base_failed AND NOT kept").count() == 0


def test_search_keeps_huge_and_tiny_components(spark):
    big = [(0, [1e200, 1.0]), (20, [1.0, 1e-200]), (1, [2.0, 1.0]), (2, [1e200, 0.0]), (3, [-1e200, 5.0]), (4, [1e-310, 0.0]),
           (5, [1e308, 1e308])]
    df = spark.createDataFrame(big, "vec_id long, embedding array<double>")
    got = {}
    for r in ann.search(df, ann.F.pmod("vec_id", ann.F.lit(20)) == 0).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    for q in (0, 20):
        x = dict(big)[q]
        rest = sorted(((-(x[0] * v[0] + x[1] * v[1]), i) for i, v in big if i != q))
        assert [(i, -s) for s, i in rest] == [(i, s) for _, i, s in sorted(got[q])]


def test_many_languages_are_all_kept(spark):
    from meteora.llm import language_id
    data = [(i, f"wort{i % 90:02d} " * 8 + chr(97 + i % 26) * 30, f"l{i % 90:02d}", "s", 1) for i in range(270)]
    names, logs = language_id.fit(R.docs(spark, data), 2)
    assert len(names) == 90 and logs.shape[0] == 90


def test_labels_are_all_used(spark):
    labels = spark.range(70_000).selectExpr("id AS doc_id", "1 AS quality")
    halves = [quality.labelled(labels, half, most) for half, most in ((0, quality.TRUSTED), (1, quality.HELD_OUT))]
    assert sum(x.count() for x in halves) == 70_000
    assert halves[0].join(halves[1], "doc_id").count() == 0


def test_pairs_of_a_family_are_made_once(spark):
    words = [f"0L AS s{i}" for i in range(ngram_join.SKETCH)]
    member = spark.range(6).crossJoin(spark.range(200).withColumnRenamed("id", "sig"))
    # 6 classes of 100 tokens in 200 signatures; the last shares its first one alone
    placed = (member.where("id < 5 OR sig = 0").selectExpr(
        "sig", "0L AS rare", "id AS key", "100L AS size", *words, "IF(id < 2, 0L, id) AS label"))
    got = [(r.a, r.b) for r in ngram_join._cross(placed, 80, 100).collect()]
    assert sorted(got) == [(a, b) for a in range(6) for b in range(a + 1, 6) if b > 1]


def test_packing_searches_on():
    import pyarrow as pa
    rng, lengths = np.random.default_rng(1), []
    for _ in range(20):  # three pieces fill a bin
        a, b = int(rng.integers(520, 760)), int(rng.integers(520, 760))
        lengths += [a, b, 2048 - a - b]
    rows = pa.RecordBatch.from_pylist([{"shard": 0, "island": i, "lengths": sorted(lengths, reverse=True), "packings": None,
                                        "guest": None} for i in range(2)])
    found = packing._evolve_pass(0, 2048, packing.POPULATION, packing.GENERATIONS)([rows])
    assert min(r["bins"] for x in found for r in x.to_pylist()) <= 21  # 22 after three children
    assert packing.least_bins(lengths, 2048) == 20
    assert packing.least_bins([1100 + (i * 7919) % 800 for i in range(600)], 2048) == 600
    assert [packing.least_bins(x, 10) for x in ([], [10], [6, 6, 5, 5], [7, 7, 7, 3, 3, 4])] == [0, 1, 3, 4]


def test_packing_search_is_in_arrays():
    """Best fit equals a plain loop; a child takes few Python calls (some for
    every bin and displaced piece before)."""
    import sys
    import pyarrow as pa
    rng = np.random.default_rng(2)
    lengths = np.sort(rng.integers(1, 400, 300))[::-1].copy()
    x = packing._pack(lengths, np.arange(300), 2048)
    space = []
    for n in lengths.tolist():
        fits = [s for s in space if s >= n]
        if fits:
            space.remove(min(fits))
        space.append(min(fits, default=2048) - n)
    assert sorted(x.fill) == sorted(2048 - s for s in space)
    y = packing._pack(lengths, rng.permutation(300), 2048)
    for z in (packing.crossover(x, y, lengths, 2048, rng), packing.mutate(y, lengths, 2048, rng)):
        assert z.at.min() == 0 and np.array_equal(np.bincount(z.at, lengths), z.fill) and z.fill.max() <= 2048
        assert z.fitness[0] == -len(z.fill)
    hard, calls = [500 + (i * 7919) % 400 for i in range(600)], 0
    rows = pa.RecordBatch.from_pylist([{"shard": 0, "island": 0, "lengths": sorted(hard, reverse=True), "packings": None,
                                        "guest": None}])

    def seen(frame, event, arg):
        nonlocal calls
        calls += event == "call"

    sys.setprofile(seen)
    try:
        list(packing._evolve_pass(0, 2048, packing.POPULATION, packing.GENERATIONS)([rows]))
    finally:
        sys.setprofile(None)
    assert calls < 400 * (packing.POPULATION + packing.GENERATIONS)


def test_quality_shuffles_labelled_texts_alone(spark, monkeypatch):
    """The rows that are counted aren't joined, only rows that share a hash
    with a label are shuffled, and no plan holds the weights."""
    plans, write = {}, quality.scratch

    def watched(df, what, *codec):
        plans[what] = df._jdf.queryExecution().toString()
        return write(df, what, *codec)

    monkeypatch.setattr(quality, "scratch", watched)
    data = [(i, R.prose(i, 40), "en", "a", 1) for i in range(200)] + [(5, "again", "en", "a", 1), (None, "x", "en", "a", 1)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(100)] + [(5, 0), (5, 1), (999, 1), (None, 1)],
                                   "doc_id long, quality int")
    got = quality.keep_good(R.docs(spark, data), labels)
    assert "Join" not in plans["counts"]
    assert "BroadcastHashJoin [_word" in plans["trusted"] and "ShuffledHashJoin [doc_id" in plans["trusted"]
    assert all(len(p) < 50_000 for p in [*plans.values(), got._jdf.queryExecution().toString()])
    want = Counter(t for i, t, *_ in data if i is not None and i < 100 and i % 2)
    assert Counter(r.text for r in quality.trusted_texts(R.docs(spark, data), labels).collect()) == want
    monkeypatch.setattr(quality, "HASH_WORDS", 1)  # bits that ids share
    assert Counter(r.text for r in quality.trusted_texts(R.docs(spark, data), labels).collect()) == want
