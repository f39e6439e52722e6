import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tests_data import SF_DIR

from pulseframe.llm import licences, neighbours, toxicity, url_filter
from pulseframe.llm.common import table

BIG, LARGER = "/root/testdata/sf0.01", "/root/testdata/sf0.1"

# ---- op1


def brute_url(url):
    """Host, path and rule, word by word as stated."""
    if url is None or "://" not in url:
        return "", "", None
    rest = url[url.index("://") + 3:]
    at = min([rest.index(c) for c in "/?#" if c in rest] or [len(rest)])
    host, rest = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:at]), rest[at:]
    path = rest[:min([rest.index(c) for c in "?#" if c in rest] or [len(rest)])]
    fits = []
    for _, rule in url_filter.RULES:
        domain, below = rule[:rule.index("/")], rule[rule.index("/"):]
        if (host == domain or host.endswith("." + domain)) and path.startswith(below):
            fits.append(rule)
    return host, path, max(fits, key=len) if fits else None


ODD_URLS = [
    None, "", "no scheme", "http://", "http://Example.ORG/es/1?x#y", "https://a.example.org/en/12", "https://notexample.org/es/",
    "http://x.com/fr/1", "http://x.com/de", "http://x.com/de/", "http://ÉCOLE.Org/", "http://org", "http://org/", "http://a.org?x=/es/",
    "http://a.org#/es/", "http://u:p@example.org:80/es/", "weird://b.net/a://c.org/", "http://example.org/es/\nnext", "http://exampleXorg/es/",
    "http://" + "long" * 30_000 + ".com/de/x", "http://ſ.com/fr/",
]


def test_hosts_paths_and_rules(spark):
    rows = [(n, u, "a", "b", "c", "d") for n, u in enumerate(ODD_URLS)] * 2
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, path string, score string, verdict string")
    got = url_filter.judge_pages(pages).collect()
    assert len(got) == len(rows)
    verdicts = {rule: verdict for verdict, rule in url_filter.RULES}
    for r in got:
        assert (r["host"], r["path"], r["rule"]) == brute_url(ODD_URLS[r["page_id"]])
        assert r["verdict"] == (verdicts[r["rule"]] if r["rule"] else "block" if r["score"] > 0.5 else "allow")
    assert url_filter.judge_pages(pages.limit(0)).count() == 0


def test_regression_on_held_out_urls(spark):
    """Trained on half of the pages that rules decide, tested on the others."""
    decided = url_filter.parts(table(spark, LARGER, "pages")).where("rule IS NOT NULL").distinct().collect()
    verdicts = {rule: int(verdict == "block") for verdict, rule in url_filter.RULES}
    rows = [(r["host"], r["path"], verdicts[r["rule"]]) for r in decided]
    split = [zlib.crc32(f"{h}{p}".encode()) % 2 for h, p, _ in rows]
    model = url_filter.train([r for r, half in zip(rows, split, strict=True) if half])
    tested = [(model.score(h, p) > 0.5) == bool(y) for (h, p, y), half in zip(rows, split, strict=True) if not half]
    assert len(tested) > 300 and np.mean(tested) >= 0.8


def test_regression_on_the_pages(spark):
    judged = url_filter.judge_pages(table(spark, BIG, "pages")).where("rule IS NULL").toPandas()
    spam = judged.host.str.contains("casino|bets|pills|adult|spam|track")
    assert (judged.verdict[spam] == "block").mean() >= 0.9
    assert (judged.verdict[~spam] == "allow").mean() >= 0.9


def test_without_labels_everything_undecided_is_allowed(spark):
    pages = spark.createDataFrame([(1, "http://x.net/")], "page_id long, url string")
    none = spark.createDataFrame([], "url string, label int")
    assert [(r["score"], r["verdict"]) for r in url_filter.judge_pages(pages, none).collect()] == [(0.5, "allow")]


# ---- op2


def scored(spark, docs, labels):
    return {r["doc_id"]: r for r in toxicity.score_documents(docs, labels).collect()}


@pytest.fixture(scope="module")
def toxic_tables(spark):
    return table(spark, BIG, "documents"), table(spark, BIG, "labels")


def test_held_out_accuracy(spark):
    docs, labels = table(spark, LARGER, "documents"), table(spark, LARGER, "labels")
    got = scored(spark, docs, labels)
    assert all(r["held_out"] == (zlib.crc32(str(d).encode()) % 3 == 1) for d, r in got.items())
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in got.values())
    known = [(got[r["doc_id"]], r["toxic"]) for r in labels.collect() if got[r["doc_id"]]["held_out"]]
    hits = sum(g["predicted"] and y for g, y in known)
    assert hits >= 0.85 * sum(y for _, y in known)
    assert hits >= 0.97 * sum(g["predicted"] for g, _ in known)


def test_held_out_labels_and_other_columns_are_not_read(spark, toxic_tables):
    docs, labels = toxic_tables
    before = scored(spark, docs, labels)
    flipped = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    other = docs.withColumn("lang", F.lit("xx")).withColumn("source", F.lit(None).cast("string")).withColumn("score", F.lit("clash"))
    after = scored(spark, other, flipped)
    assert {d: r["score"] for d, r in before.items()} == {d: r["score"] for d, r in after.items()}


def test_edge_rows_of_toxicity(spark, toxic_tables, edge_docs, no_docs):
    _, labels = toxic_tables
    none = labels.limit(0)
    rows = toxicity.score_documents(edge_docs, none).collect()
    assert len(rows) == edge_docs.count() and all(r["score"] < 1e-9 for r in rows)
    odd = spark.createDataFrame([(5, None), (6, 3), (None, 1), (3, 1), (4, 0), (9, 1), (9, 0), (8, 0)], "doc_id long, toxic int")
    rows = toxicity.score_documents(edge_docs, odd).collect()
    assert len(rows) == edge_docs.count()
    empty = {r["score"] for r in rows if r["doc_id"] in (1, 2, 7)}
    assert len(empty) == 1
    assert toxicity.score_documents(no_docs, labels).count() == 0
    kept = toxicity.without_toxic(edge_docs, none)
    assert kept.columns == edge_docs.columns and kept.count() == edge_docs.count()


def test_a_small_toxic_group_is_learnt():
    """One and a half per cent of the toxic rows in a language of their own, which has clean rows, too."""
    pick = np.random.default_rng(11)
    words = {g: [f"{g}{a}{b}{c}" for a in "bdklm" for b in "aeiou" for c in "nrstz"] for g in ("ra", "wu")}
    bad = {"ra": ["zorgly", "snivex", "blattar", "quorbin", "mugwith"], "wu": ["xhemot", "ykkeral", "vufane", "jibrosk", "oolwend"]}

    def text(group, toxic):
        chosen = list(pick.choice(words[group], 60))
        return " ".join(chosen + (list(pick.choice(bad[group], 4, replace=False)) if toxic else []))

    sample = toxicity.Sample(toxic_share=0.3)
    for group, toxic, rows in (("ra", 1, 1000), ("ra", 0, 1400), ("wu", 1, 15), ("wu", 0, 60)):
        for _ in range(rows):
            sample.add(text(group, toxic), float(toxic))
    score = toxicity.fitted(sample).scorer()
    for group in ("ra", "wu"):
        assert np.mean([score(text(group, 1)) >= toxicity.THRESHOLD for _ in range(60)]) >= 0.9
        assert np.mean([score(text(group, 0)) >= toxicity.THRESHOLD for _ in range(200)]) <= 0.02


def test_no_vote_for_clean_on_unknown_words():
    sample = toxicity.Sample()
    for n in range(20):
        sample.add("plain words of a clean text" + (" zorgly" if n % 2 else ""), float(n % 2))
    sample.add("nothing here was ever seen", np.nan)
    sample.add("plain words of a text", np.nan)
    ballot = toxicity.votes(sample, [("zorgly$", False)])
    assert not ballot[-2].any() and ballot[-1, -2:].tolist() == [-1, -1]


def test_label_model_discounts_copies_of_a_voter():
    pick = np.random.default_rng(0)
    truth = pick.random(4000) < 0.2
    vote = lambda right: np.where(pick.random(4000) < right, np.where(truth, 1, -1), np.where(truth, -1, 1))
    good = [vote(0.85) for _ in range(4)]
    ballot = np.stack([*good, *[good[0]] * 5], axis=1).astype("i1")
    model = toxicity.label_model(ballot, 0.2)
    assert model.own[0] < 0.35 and model.own[1] > 0.6
    assert ((model.posterior(ballot) > 0.5) == truth).mean() > 0.9


# ---- op5


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, score string")


def exact(rows, every=50, k=5):
    ids = np.array([r[0] for r in rows])
    x = np.array([r[1] for r in rows], "f4").astype("f8")
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    out = {}
    for n in np.flatnonzero(ids % every == 0):
        cosine = x @ x[n]
        cosine[ids == ids[n]] = -9
        order = np.lexsort((ids, -np.round(cosine, 12)))[:k]
        out[int(ids[n])] = [(int(ids[o]), cosine[o]) for o in order]
    return out


def test_recall_against_brute_force(spark):
    pick = np.random.default_rng(3)
    centres = pick.standard_normal((40, 48))
    rows = [(n, (centres[n % 40] + 0.4 * pick.standard_normal(48)).astype("f4").tolist(), 0, "x") for n in range(6000)]
    true = exact(rows)
    found = neighbours.nearest_neighbours(vectors(spark, rows), block=500).collect()
    got = {}
    for r in found:
        got.setdefault(r["query_id"], {})[r["rank"]] = (r["vec_id"], r["score"])
    assert set(got) == set(true) and all(sorted(g) == [1, 2, 3, 4, 5] for g in got.values())
    hits = sum(len({v for v, _ in got[q].values()} & {v for v, _ in true[q]}) for q in true)
    assert hits >= 0.9 * 5 * len(true)
    for q, ranks in got.items():
        scores = [ranks[n][1] for n in range(1, 6)]
        assert scores == sorted(scores, reverse=True)
        for v, s in ranks.values():
            a, b = np.array(rows[q][1], "f4").astype("f8"), np.array(rows[v][1], "f4").astype("f8")
            assert s == pytest.approx(a @ b / np.linalg.norm(a) / np.linalg.norm(b), abs=1e-12)


def test_recall_on_the_table(spark):
    table_ = table(spark, SF_DIR, "embeddings")
    rows = [(r["vec_id"], r["embedding"]) for r in table_.collect()]
    true = exact(rows)
    found = {(r["query_id"], r["vec_id"]) for r in neighbours.nearest_neighbours(table_).collect()}
    assert len(found & {(q, v) for q, near in true.items() for v, _ in near}) >= 0.9 * 5 * len(true)


def test_ties_bad_vectors_and_repeated_rows(spark):
    same = [1.0, 2.0, 3.0]
    rows = [(n, same, 0, "x") for n in range(0, 400)]  # all alike: ties go to the smaller ids
    rows += [(1000, None, 0, "x"), (1050, [0.0, 0.0, 0.0], 0, "x"), (1100, [float("nan"), 1.0, 1.0], 0, "x"),
             (1150, [None, 1.0, 1.0], 0, "x"), (1200, [float("inf"), 1.0, 1.0], 0, "x"), (1250, [1.0], 0, "x"), (None, same, 0, "x"), (1, same, 0, "x")]
    found = neighbours.nearest_neighbours(vectors(spark, rows), block=64).orderBy("query_id", "rank").collect()
    assert {r["query_id"] for r in found} == set(range(0, 400, 50))
    assert [r["vec_id"] for r in found if r["query_id"] == 0] == [1, 2, 3, 4, 5]
    assert [r["vec_id"] for r in found if r["query_id"] == 50] == [0, 1, 2, 3, 4]
    assert all(r["score"] == pytest.approx(1.0) for r in found)


def test_few_and_no_vectors(spark):
    few = neighbours.nearest_neighbours(vectors(spark, [(0, [1.0, 0.0], 0, "x"), (7, [0.5, 0.5], 0, "x"), (9, [-1.0, 0.0], 0, "x")]))
    assert [(r["query_id"], r["rank"], r["vec_id"]) for r in few.orderBy("rank").collect()] == [(0, 1, 7), (0, 2, 9)]
    assert neighbours.nearest_neighbours(vectors(spark, [])).count() == 0
    assert neighbours.nearest_neighbours(vectors(spark, [(50, [1.0], 0, "x")])).count() == 0


# ---- op9


def brute_licences(text):
    """The best template of every unit, without pruning."""
    found = []
    for start, end in licences.units(text or ""):
        unit = text[start:end]
        own = licences.Counter(licences.bigrams(unit))
        best = [
            (2 * sum((own & (t := licences.Counter(licences.bigrams(x)))).values()) / (sum(own.values()) + sum(t.values())), name)
            for name, group in licences.TEMPLATES.items() for x in group if own
        ]
        if best and max(best)[0] >= licences.DICE:
            score = max(b[0] for b in best)
            found.append((start, end, min(n for s, n in best if s == score), score))
    reported, out = -1, []
    for f in found:
        if f[1] > reported:
            out.append(f)
            reported = f[1]
    return out


def test_licences_of_the_table(spark):
    docs = table(spark, BIG, "documents")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    got = {}
    for r in licences.scan_documents(docs).collect():
        got.setdefault(r["doc_id"], []).append((r["start"], r["end"], r["licence"], r["dice"]))
    assert got == {d: f for d, t in texts.items() if (f := brute_licences(t))}
    assert got


def test_whole_licences_and_near_texts():
    mit = licences.TEMPLATES["MIT"][-1]
    prose = "Some prose that is about something else altogether. " * 40
    wrapped = prose + "\n\n" + "\n".join(line.strip() for line in mit.split("\n")) + "\n\n" + prose
    ((start, end, name, score),) = licences.found_in(wrapped, licences.Templates())
    assert name == "MIT" and score == 1.0 and wrapped[start:end].startswith("Permission is hereby")
    changed = mit.replace("sublicense, and/or sell", "lend or give away").replace("NONINFRINGEMENT", "QUIET")
    assert [f[2] for f in licences.found_in(changed, licences.Templates())] == ["MIT"]
    assert licences.found_in("Released under the terms of no licence at all.", licences.Templates()) == []
    assert [f[2] for f in licences.found_in("LICENSED@@ under## CC by-nc 9.9!!", licences.Templates())] == ["CC-BY-NC"]


def test_edge_rows_of_licences(edge_docs, no_docs):
    assert licences.scan_documents(edge_docs).count() == 0
    assert licences.scan_documents(no_docs).count() == 0


def in_paragraphs(text, *starts):
    """A template in its usual layout, with blank lines before the given words."""
    text = " ".join(text.split())
    for words in starts:
        assert words in text
        text = text.replace(words, f"\n\n{words}", 1)
    return text


LAYOUTS = {
    "MIT": ["The above copyright notice", "THE SOFTWARE IS PROVIDED"],
    "BSD": ["1. Redistributions", "2. Redistributions", "THIS SOFTWARE IS PROVIDED"],
    "GPL": ["This program is distributed", "You should have received"],
    "Apache": ["http://www.apache.org", "Unless required"],
}


@pytest.mark.parametrize("name", LAYOUTS)
@pytest.mark.parametrize("head", ["", "Copyright (c) 2020 Jane Doe. All rights reserved.\n", "/*\n * Copyright 2020\n *\n * "])
def test_licences_with_blank_lines_between_prose(name, head):
    prose = "Some prose that is about something else altogether.\n" * 40
    body = in_paragraphs(licences.TEMPLATES[name][-1], *LAYOUTS[name])
    text = prose + "\n" + head + body + "\n\n" + prose
    ((start, end, found, score),) = licences.found_in(text, licences.Templates())
    assert found == name and score == 1.0
    assert licences.bigrams(text[start:end]) == licences.bigrams(body)


@pytest.mark.parametrize(("text", "names"), [
    ("Copyright (c) 2020 Jane Doe. Released under the MIT License.", ["MIT"]),
    ("İn short, we say that this is licensed under the Apache License, Version 2.0, as are most of our tools.", ["Apache"]),
    ("The code is released under the MIT License and the texts are licensed under CC BY-NC 4.0 from now on.", ["MIT", "CC-BY-NC"]),
    ("As the site says, this work is licensed under the GNU General Public License, version 3, like all others.", ["GPL"]),
    ("See the header of the file: SPDX-License-Identifier: Zlib is what it says there.", []),
    ("It was released under the terms of a licence and in the public domain of the world.", []),
])
def test_notices_inside_longer_lines(text, names):
    found = licences.found_in(text, licences.Templates())
    assert [f[2] for f in found] == names
    assert all(text[s - 1:s].strip(" ") == "" and score == 1.0 for s, _, _, score in found)


def test_windows_equal_all_windows():
    """Against every window from the size of the template on, one template at a time, on its own words with changes."""
    pick, seen = np.random.default_rng(4), 0
    for name, group in licences.TEMPLATES.items():
        for own in group:
            size = len(licences.bigrams(own))
            if size > 12:
                continue
            chain = licences.WORDS.findall(own.lower())
            for _ in range(6):
                words = [str(w) for w in pick.choice([*chain, "rain", "stone", "cloud"], 30)]
                words[10:10] = [w if pick.random() < 0.9 else "rain" for w in chain]
                pairs, count = licences.bigrams(" ".join(words)), licences.Counter(licences.bigrams(own))
                best = max(
                    2 * sum((licences.Counter(pairs[a:b]) & count).values()) / (b - a + size)
                    for a in range(len(pairs)) for b in range(a + size, min(len(pairs), 2 * size + a) + 1)
                )
                got = licences.windows_in(" ".join(words), licences.Templates({name: [own]}))
                assert (max(g[3] for g in got) if got else 0.0) == pytest.approx(best if best >= licences.DICE else 0.0)
                seen += bool(got)
    assert seen > 60
