"""Language identification, components, the pipeline and the registry."""

import math
from collections import Counter, defaultdict
from urllib.parse import urlsplit

import corpus_pipeline
from meteora.llm import common, language_id, queries
from tests.conftest import SF001
from tests.llm import rows as R


def test_components(spark):
    edges = [(i, i + 1) for i in range(30)] + [(100, 7), (200, 201), (201, 200), (300, 300)]
    got = {r.node: r.label for r in common.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in [*range(31), 100]} | {200: 200, 201: 200}
    assert common.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_language_agrees_with_declared_markup(spark):
    got = queries.op7_language_id(spark, "/root/testdata/sf0.01")
    r = got.selectExpr("avg(CAST(lang = declared AS INT)) AS right", "count(*) AS n").first()
    assert r.n == spark.read.parquet("/root/testdata/sf0.01/pages.parquet").count() and r.right > 0.95


def test_language_awkward_rows(spark):
    labelled = spark.read.parquet(f"{SF001}/documents.parquet")
    text = labelled.where("lang = 'fr' AND length(text) > 500").first().text
    pages = [(1, "https://a.example.fr/x", f"<html lang='fr'><p>{text}</p>"), (2, None, None), (3, "no address", ""),
             (4, "http://a.example.fr", "<html lang=fr>"), (4, "http://a.example.fr", "<html lang=fr>"),
             (None, "http://u@b.example.com:80/", f"<html><script>var x</script>{text}" * 30)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").selectExpr("*", "'x' AS host")
    got = language_id.identify(df, labelled).collect()
    assert len(got) == 6
    assert {r.lang for r in got if r.page_id in (1, 4, None)} == {"fr"}
    assert all(0 < r.probability <= 1 for r in got)
    assert {r.host for r in got} == {"a.example.fr", None, "b.example.com"}
    assert language_id.identify(df.limit(0), labelled).count() == 0
    assert {r.lang for r in language_id.identify(df, labelled.limit(0)).collect()} == {None}


def plain_languages(pages, labelled):
    """(page_id, language, probability) by dictionaries and loops."""
    def grams(text):
        b = " ".join(text.lower().split()).encode()
        for x, y, z in zip(b, b[1:], b[2:], strict=False):
            code = (x * 65599 * 65599 + y * 65599 + z) % (1 << 32)
            yield (((code ^ code >> 15) * 2654435761) % (1 << 32)) >> 19

    names = sorted({r.lang for r in labelled if r.lang is not None and r.doc_id is not None})
    seen = {x: Counter(g for r in labelled if r.lang == x and r.doc_id is not None for g in grams(r.text or "")) for x in names}
    room = {x: sum(seen[x].values()) + language_id.BUCKETS for x in names}
    rows, by_host, by_domain, world = [], defaultdict(Counter), defaultdict(Counter), Counter()
    facts = {"declared": defaultdict(Counter), "suffix": defaultdict(Counter)}
    for r in pages:
        g = list(grams(language_id.visible_text(r.html)))
        score = {x: sum(math.log((seen[x][k] + 1) / room[x]) for k in g) / len(g) * min(len(g), language_id.TEMPER) if g else 0.0
                 for x in names}
        best = max(names, key=score.get) if g else None
        host = urlsplit(r.url or "").hostname
        mark = (r.html or "").lower().partition("<html lang=")[2].lstrip("'\"")
        declared = "".join(c if c.isalpha() else " " for c in mark[:20]).split(" ")[0] or None
        suffix = host and host.split(".")[-1]
        domain = host and ".".join(host.split(".")[-2:])
        rows.append((r.page_id, score, host, domain, {"declared": declared, "suffix": suffix}))
        world[best] += 1
        if host:
            by_host[host][best] += 1
            by_domain[domain][best] += 1
        for f, v in (("declared", declared), ("suffix", suffix)):
            if v:
                facts[f][v][best] += 1
    del world[None]
    everywhere = {x: (world[x] + 1) / (sum(world.values()) + len(names)) for x in names}

    def smooth(counts, x, prior):
        return (counts[x] + language_id.SMOOTH * prior) / (sum(counts[y] for y in names) + language_id.SMOOTH)

    for page, score, host, domain, values in rows:
        total = {}
        for x in names:
            prior = smooth(by_host[host], x, smooth(by_domain[domain], x, everywhere[x])) if host else everywhere[x]
            total[x] = score[x] + math.log(prior)
            for f, v in values.items():
                if v:
                    whole = sum(c[x] for c in facts[f].values())
                    total[x] += math.log((facts[f][v][x] + 1) / (whole + len(facts[f])))
        lang = max(names, key=total.get)
        yield page, lang, 1 / sum(math.exp(v - total[lang]) for v in total.values())


def test_language_equals_plain_fusion(spark):
    pages = spark.read.parquet(f"{SF001}/pages.parquet")
    labelled = spark.read.parquet(f"{SF001}/documents.parquet")
    want = {p: (lang, prob) for p, lang, prob in plain_languages(pages.collect(), labelled.collect())}
    got = language_id.identify(pages, labelled).collect()
    assert len(got) == len(want)
    for r in got:
        assert r.lang == want[r.page_id][0] and abs(r.probability - want[r.page_id][1]) < 1e-6


def test_language_ties_go_to_the_first_name(spark):
    labelled = spark.createDataFrame([(1, "same words here", "b"), (2, "same words here", "a")], "doc_id long, text string, lang string")
    pages = spark.createDataFrame([(1, "http://x.example", "same words"), (2, None, "other")], "page_id long, url string, html string")
    assert {r.lang for r in language_id.identify(pages, labelled).collect()} == {"a"}


def test_pipeline_stages(spark):
    d = SF001
    docs = spark.read.parquet(f"{d}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    counts = [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        out = common.scratch(stage(spark, docs, d), "test")
        if name != names[-1]:
            assert out.columns == docs.columns
        counts.append(out.count())
        docs = out
    assert counts[1] < counts[0] and counts[3] < counts[2]
    total = corpus_pipeline.run(spark, d)
    assert total.count() == counts[-1]
    common.drop_scratch(spark)


def test_pipeline_drops_what_line_dedup_left_of_near_copies(spark, tmp_path):
    lines = [R.prose(40 + i, 30).replace("\n", "") for i in range(10)]  # 30 words each
    edited = [*lines[:4], lines[4].replace(lines[4].split()[5], "edited"), *lines[5:]]
    twice = [(7, "one text of an id", "en", "a", 1), (7, "\n".join(lines[:6] + ["another text of it"]), "en", "a", 1)]
    data = [(1, "\n".join(lines), "en", "a", 1), (2, "\n".join(edited), "en", "a", 1), (3, R.prose(99, 60), "en", "a", 1),
            (None, R.prose(98, 40), "en", "a", 1), *twice]
    R.docs(spark, data, extra=False).write.parquet(str(tmp_path / "documents.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    cut = common.scratch(corpus_pipeline.lines(spark, docs, str(tmp_path)), "test")
    assert cut.count() == len(data)  # a line of document 2 is its own
    kept = corpus_pipeline.near_copies(spark, cut, str(tmp_path)).collect()
    assert sorted(r.doc_id or 0 for r in kept) == [0, 1, 3, 7, 7]
    common.drop_scratch(spark)


def test_pipeline_takes_awkward_rows(spark, tmp_path):
    docs = R.docs(spark).selectExpr("*", "1 AS _gone", "2 AS _lines", "3 AS _copy", "4 AS row", "5 AS lines", "6 AS gone")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.read.parquet(f"{SF001}/labels.parquet").write.parquet(str(tmp_path / "labels.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() > 0
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, str(tmp_path)).columns == docs.columns
    R.empty(spark).write.parquet(str(tmp_path / "none/documents.parquet"))
    spark.read.parquet(f"{SF001}/labels.parquet").write.parquet(str(tmp_path / "none/labels.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path / "none")).count() == 0


def test_registry():
    import __spark_entry__ as entry
    assert set(queries.QUERIES) | {"pipeline"} <= set(entry.queries())
    assert set(queries.ORACLES) <= set(entry.oracle_sql())
