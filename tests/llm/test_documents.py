"""Near copies, paragraphs, languages, mixing and the pipeline against brute force."""

import hashlib
import random
import re

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from roadledger.llm import bayes_join, language, mixing, paragraph_dedup
from roadledger.llm.common import parted
from roadledger.llm.components import components
from roadledger.llm.queries import QUERIES
from tests.llm.helpers import LONG, docs, roots, shingles, similar_pairs, words

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def texts(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").collect()
    return {r.doc_id: r.text for r in rows}


def clashing(frame):
    """Further columns with names that the operators use themselves."""
    return frame.withColumns(
        {n: F.lit("mine") for n in ("rid", "sig", "text_key", "kept", "lines", "line", "size",
                                    "target", "n", "y", "root", "_key", "language", "copies")}
    )


def test_components_of_paths_stars_and_loops(spark):
    rows = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)]
    rows += [(200, 201), (201, 202), (202, 200), (300, 300)]
    frame = spark.createDataFrame(rows, "a bigint, b bigint")
    got = {r.node: r.root for r in components(frame).collect()}
    want = roots({x for r in rows for x in r}, rows)
    want.pop(300)
    assert got == want
    assert components(frame.limit(0)).count() == 0


def test_components_take_no_round_once_edges_are_stars(spark, monkeypatch):
    from roadledger.llm import components as module

    rounds, kept = [], module.stored
    monkeypatch.setattr(module, "stored", lambda f, name: rounds.append(name) or kept(f, name))
    frame = spark.createDataFrame([(1, 2), (3, 1), (1, 3), (5, 7), (6, 5)], "a int, b int")
    got = {r.node: r.root for r in components(frame).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 5: 5, 6: 5, 7: 5} and len(rounds) == 1
    got = {r.node: r.root for r in components(frame.where("a < 6 and b < 6 or a = 6")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 5: 5, 6: 5} and len(rounds) == 2
    assert {r.root for r in components(frame.union(frame.select("b", F.col("a") + 4))).collect()} == {1}


def test_a_round_of_components_has_one_branch(spark, monkeypatch):
    from roadledger.llm import components as module

    plans, kept = [], module.stored
    note = lambda f: plans.append(f._jdf.queryExecution().executedPlan().toString())
    monkeypatch.setattr(module, "stored", lambda f, name: note(f) or kept(f, name))
    frame = spark.createDataFrame([(i, i + 1) for i in range(12)], "a int, b int")
    out = components(frame)
    note(out)
    assert {r.root for r in out.collect()} == {0} and len(plans) > 3
    assert not any("Union" in plan for plan in plans)


def test_parted_never_misses_a_wanted_key(spark):
    rows = spark.range(5000).select("id", F.xxhash64("id").alias("h"))
    wanted = rows.where("id % 50 = 3").select(F.col("h").alias("w"))
    some, none = parted(rows, F.col("h"), wanted, F.col("w"))
    ids = {r.id for r in some.collect()}
    assert {i for i in range(5000) if i % 50 == 3} <= ids and len(ids) < 120
    assert none.count() == 5000 - len(ids)
    some, none = parted(rows, F.col("h"), wanted.limit(0), F.col("w"))
    assert (some.count(), none.count()) == (0, 5000)


# --- near copies ----------------------------------------------------------


def test_join_query_against_brute_force(spark, texts):
    sets = {i: shingles(t) for i, t in texts.items()}
    pairs = similar_pairs(sets)
    root = roots(sets, pairs)
    links = {i: 0 for i in sets}
    for a, b in pairs:
        links[a] += 1
        links[b] += 1
    got = QUERIES["op5_bayes_jaccard_join"](spark, SF).collect()
    assert {r.doc_id: (r.class_id, r.n_links) for r in got} == {
        i: (root[i], links[i]) for i in sets
    }
    assert len(got) == len(texts) and pairs


def variants(count, edits, length=60):
    """Texts of a family with a few words replaced each."""
    rng = np.random.default_rng(4)
    out = []
    for k in range(count):
        w = words(length).split()
        for at in rng.integers(0, length, edits):
            w[at] = f"edit{k}x{at}"
        out.append(" ".join(w))
    return out


def test_dense_group_in_blocks_loses_no_link(spark, monkeypatch):
    monkeypatch.setattr(bayes_join, "BLOCK", 16)
    family = variants(90, 1, 120) + [words(80, 5000 + 100 * i) for i in range(30)]
    sets = {i: shingles(t) for i, t in enumerate(family)}
    pairs = similar_pairs(sets)
    links = {i: 0 for i in sets}
    for a, b in pairs:
        links[a] += 1
        links[b] += 1
    got = bayes_join.join_documents(docs(spark, family)).collect()
    assert {r.doc_id: r.n_links for r in got} == links and len(pairs) > 500


def test_join_edge_cases(spark):
    same = words(30)
    texts = [None, "", " \n\t", same, same.upper(), "a b", "a  b", "b a", LONG, LONG + " x", same]
    got = bayes_join.join_documents(clashing(docs(spark, texts))).collect()
    assert {r.doc_id: (r.class_id, r.n_links) for r in got} == {
        0: (0, 0), 1: (1, 0), 2: (2, 0), 3: (3, 2), 4: (3, 2), 5: (5, 1), 6: (5, 1),
        7: (7, 0), 8: (8, 1), 9: (8, 1), 10: (3, 2),
    }
    nameless = docs(spark, [same, same]).withColumn(
        "doc_id", F.when(F.col("doc_id") == 0, 9).cast("bigint")
    )
    assert [(r.class_id, r.n_links) for r in bayes_join.join_documents(nameless).collect()] == [
        (9, 1)
    ] * 2
    assert bayes_join.join_documents(docs(spark, [])).count() == 0


def test_one_of_each_keeps_firsts_and_all_others(spark):
    same = words(30)
    frame = docs(spark, [None, None, "", same, same, "alone here", same + " x"])
    frame = frame.union(frame.where("doc_id IN (3, 5)"))
    got = bayes_join.one_of_each(clashing(frame))
    assert got.columns == clashing(frame).columns
    # The repeated row of document 3 is a copy of it; that of 5 is a copy of 5.
    assert sorted(r.doc_id for r in got.collect()) == [0, 1, 2, 3, 5]
    assert bayes_join.one_of_each(frame.limit(0)).count() == 0


def test_posterior_limits_grow_and_spare_the_threshold():
    least = bayes_join.least_matches()
    assert list(least) == list(range(24, 241, 24))
    assert all(least[n] / n < 0.75 for n in least) and least[240] / 240 > 0.68


def test_all_looks_together_lose_few_pairs_at_the_threshold():
    least, agree = bayes_join.least_matches(), 0.8 + 0.2 / 256
    chance, lost = np.ones(1), 0.0
    for n in sorted(least):
        for _ in range(bayes_join.STEP):
            chance = np.convolve(chance, [1 - agree, agree])
        lost += chance[: least[n]].sum()
        chance[: least[n]] = 0
    assert lost < 1e-4


# --- paragraphs -----------------------------------------------------------


WORD = re.compile(r"[^ \t-\r]+")


def by_hand(texts, least=50):
    """{id: (word ranges, kept text)} by all windows and all pairs of lines."""
    owner, cover, lines = {}, {}, []
    for i in sorted(texts):
        low = WORD.findall((texts[i] or "").lower())
        cover[i] = np.zeros(len(low), dtype=bool)
        for at in range(len(low) - least + 1):
            if owner.setdefault(tuple(low[at : at + least]), i) != i:
                cover[i][at : at + least] = True
        at = 0
        for line in (texts[i] or "").lower().split("\n"):
            own = WORD.findall(line)
            if len(own) >= least:
                lines.append((i, at, len(own), " ".join(own)))
            at += len(own)
    sets = {n: shingles(line[3]) for n, line in enumerate(lines)}
    same = {}
    pairs = similar_pairs(sets) | {(same.setdefault(x[3], n), n) for n, x in enumerate(lines)}
    # Lines lie in order of document, so the root is in the first one.
    for n, root in roots(range(len(lines)), pairs).items():
        i, at, count, _ = lines[n]
        if lines[root][0] != i:
            cover[i][at : at + count] = True
    out = {}
    for i, text in texts.items():
        edge = np.flatnonzero(np.diff(np.r_[0, cover[i].astype(int), 0])).tolist()
        spans = list(zip(edge[::2], edge[1::2]))
        begin = [m.start() for m in WORD.finditer(text or "")] + [len(text or "")]
        kept, at = "", 0
        for a, b in spans:
            kept, at = kept + text[at : begin[a]], begin[b]
        out[i] = (spans, None if text is None else kept + text[at:])
    return out


def cut(frame, **given):
    return {
        r.doc_id: ([(s.begin, s.end) for s in r.removed], r.text)
        for r in paragraph_dedup.cleaned(frame, **given).collect()
    }


@pytest.mark.parametrize("size", ["sf0.001", "sf0.01"])
def test_paragraph_query_against_brute_force(spark, size):
    folder = f"/root/testdata/{size}"
    rows = spark.read.parquet(f"{folder}/documents.parquet").collect()
    want = by_hand({r.doc_id: r.text for r in rows})
    got = QUERIES["op7_paragraph_dedup"](spark, folder).collect()
    assert len(got) == len(want) and any(spans for spans, _ in want.values())
    for r in got:
        spans, kept = want[r.doc_id]
        assert [(s.begin, s.end) for s in r.removed] == spans
        assert (r.kept_chars, r.text_sha256) == (
            len(kept), hashlib.sha256(kept.encode()).hexdigest()
        )


@pytest.mark.parametrize("hot", [paragraph_dedup.HOT, 1])
def test_paragraph_edge_cases(spark, hot):
    p, q = words(60), words(60, 1000)
    near = p.replace("w30", "other")
    texts = [
        None, "", "\n\n", f"{p}\nshort", f"intro\n{p}\n{q}", q, f"{near}\n{p}", words(49),
        words(49), f"{LONG}\n\n{q.upper()}\n", f"İ{LONG} and {p[3:]} end", p,
    ]
    frame = clashing(docs(spark, texts))
    got = cut(frame, hot=hot)
    assert got == by_hand(dict(enumerate(texts)))
    assert {i: spans for i, (spans, _) in got.items() if spans} == {
        4: [(1, 61)], 5: [(0, 60)], 6: [(0, 120)], 9: [(30_000, 30_060)],
        10: [(0, 30_061)], 11: [(0, 60)],
    }
    assert [got[i][1] for i in (0, 1, 2, 4, 5, 6, 9)] == [
        None, "", "\n\n", f"intro\n{q}", "", "", f"{LONG}\n\n"
    ]
    rows = paragraph_dedup.cleaned(frame).collect()
    assert {(r.lines, r.source) for r in rows} == {("mine", "s0")}
    twice = paragraph_dedup.cleaned(frame.union(frame)).collect()
    assert len(twice) == 24 and {len(r.removed) for r in twice if r.doc_id == 3} == {0}
    assert paragraph_dedup.cleaned(frame.limit(0)).count() == 0


def test_passages_are_found_apart_from_lines(spark):
    rng = random.Random(8)
    passage = words(57)
    texts = [f"own {words(rng.randint(0, 30), 5000 + 100 * i)} {passage} {words(9, 9000 + 10 * i)}"
             for i in range(12)]
    texts += [f"a\n{passage.replace(' ', chr(10))}\nb", passage.replace("w30 ", "w30\n\n ")]
    got = cut(docs(spark, texts))
    assert got == by_hand(dict(enumerate(texts)))
    assert not got[0][0] and all("w30" not in t for i, (_, t) in got.items() if i)


def test_repeats_of_one_document_stay(spark):
    p = words(60)
    texts = ["\n".join([p] * 4), f"{words(70, 500)} {words(70, 500)}", f"{p} {words(30, 7000)} {p}"]
    got = cut(docs(spark, texts))
    assert got == by_hand(dict(enumerate(texts)))
    assert not got[0][0] and not got[1][0] and got[2][1] == words(30, 7000) + " "


def test_a_common_paragraph_is_cut_everywhere_but_once(spark):
    p = words(55)
    frame = docs(spark, [f"own text {i}\n{p}" for i in range(300)])
    got = paragraph_dedup.cleaned(frame).collect()
    assert sum(len(r.removed) for r in got) == 299
    assert {r.text for r in got if r.removed} == {f"own text {i}\n" for i in range(1, 300)}


def test_edited_copies_of_one_paragraph_find_their_original(spark):
    # Each copy reaches 0.8 with the original alone, not with the other copies.
    original = [f"w{i}" for i in range(110)]
    texts = [" ".join(original)]
    for n in range(700):
        copy = list(original)
        copy[5 + n % 45], copy[55 + n // 14] = f"x{n}", f"y{n}"
        texts.append(" ".join(copy))
    got = paragraph_dedup.cleaned(docs(spark, texts)).collect()
    assert {r.doc_id for r in got if not r.removed} == {0}


def test_lines_known_from_different_documents_are_no_passage(spark):
    lines, p = [words(14, 100 * i) for i in range(4)], words(60, 1000)
    texts = [f"own {i}\n{line}" for i, line in enumerate(lines)]
    texts += ["\n".join(lines), "\n".join(lines), p, f"{lines[1]}\n{p}\n{lines[0]}"]
    got = {i: spans for i, (spans, _) in cut(docs(spark, texts)).items()}
    assert got == {i: [] for i in range(7)} | {5: [(0, 56)], 7: [(14, 74)]}


# --- language -------------------------------------------------------------


def test_language_query_agrees_with_declared_labels(spark):
    rows = QUERIES["op6_language_id"](spark, "/root/testdata/sf0.01").collect()
    assert len(rows) == 1000
    right = np.mean([r.language == r.declared for r in rows])
    text = np.mean([r.text_language == r.declared for r in rows])
    assert right >= 0.995 and text >= 0.99 and all(r.accepted for r in rows)


def test_held_out_accuracy_of_the_text_alone(spark):
    frame = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    keep = ["doc_id"]
    rows = language.evidence_rows(
        frame, F.col("text"), F.col("lang"), F.lit(""), keep
    )
    model = language.train(rows.where("doc_id % 2 = 0"), sample=60)
    scored = language.text_scores(rows.where("doc_id % 2 = 1"), model, keep).collect()
    best = [language.LANGUAGES[int(np.argmax(r._scores))] == r._declared for r in scored]
    assert len(best) == 500 and np.mean(best) >= 0.98


def test_language_evidence_and_edge_cases(spark):
    train = spark.read.parquet(f"{SF}/documents.parquet").select("text", "lang")
    french = train.where("lang = 'fr'").first().text
    rows = [
        (1, french, "FR-ca", "s"), (2, french, None, None), (3, french, "en", "s"),
        (4, None, "de", "s"), (5, "", None, ""), (6, "12 !!", "xx", "a.b.fr"), (7, LONG, "en", "s"),
    ]
    schema = "doc_id bigint, text string, lang string, source string"
    mine = spark.createDataFrame(rows, schema).withColumns(
        {n: F.lit("mine") for n in ("language", "n0", "posterior")}
    )
    labelled = language.evidence_rows(
        train, F.col("text"), F.col("lang"), F.lit(""), []
    )
    given = language.evidence_rows(
        mine, F.col("text"), F.col("lang"), F.col("source"), ["doc_id"]
    )
    got = {r.doc_id: r for r in language.identify(given, ["doc_id"], labelled).collect()}
    assert [got[i].language for i in (1, 2, 3, 4, 6)] == ["fr", "fr", "fr", "de", "fr"]
    assert [got[i].text_language for i in (4, 5, 6)] == [None] * 3
    assert got[1].declared == "fr" and got[6].declared is None
    assert got[5].posterior < language.LEAST and got[1].posterior > 0.99
    assert language.identify(given.limit(0), ["doc_id"], labelled).count() == 0
    # Nothing labelled: declaration and host decide.
    alone = language.identify(given, ["doc_id"], labelled.limit(0)).collect()
    assert {r.doc_id: r.language for r in alone}[4] == "de"


def test_host_priors_are_smoothed_towards_their_parents(spark):
    rows = [("a.x.com", k % 10 < 9) for k in range(100)] + [("b.x.com", True), ("c.org", False)]
    scored = spark.createDataFrame(
        [(h, True, [1.0, 0.0, 0.0, 0.0] if en else [0.0, 1.0, 0.0, 0.0]) for h, en in rows],
        "_host string, _lettered boolean, _scores array<double>",
    )
    got = {r._host: r._prior for r in language.host_priors(scored).collect()}
    every = (91 + 1) / (102 + 4)
    domain = (91 + 20 * (91 + 20 * every) / (101 + 20)) / (101 + 20)
    assert got["a.x.com"][0] == pytest.approx((90 + 20 * domain) / 120)
    assert got["b.x.com"][0] == pytest.approx((1 + 20 * domain) / 21)
    assert got["c.org"][0] < got["b.x.com"][0] and sum(got["c.org"]) == pytest.approx(1)


def test_pages_use_markup_and_address(spark):
    rows = [
        (1, "https://news.ciónes.es/x", "<html lang='en'><p>12</p></html>"),
        (2, None, "<html LANG=de-AT><script>var x = 'the and of'</script></html>"),
        (3, "not an address", None),
    ]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    got = {r.page_id: r for r in language.page_evidence(pages).collect()}
    assert [got[i]._declared for i in (1, 2, 3)] == ["en", "de", None]
    assert [got[i]._host for i in (1, 2, 3)] == ["news.ciónes.es", "", ""]
    assert "the and" not in got[2]._text and "12" in got[1]._text
    assert QUERIES["pages_language"](spark, SF).count() == 50


def test_accepted_rejects_the_uncertain_and_relabels(spark):
    base = spark.read.parquet(f"{SF}/documents.parquet")
    german = base.where("lang = 'de'").first().text
    # Text of no language, without a declaration; and a wrong declaration.
    odd = docs(spark, ["11 22 33", german], first=9000).withColumn(
        "lang", F.when(F.col("doc_id") == 9001, "en")
    )
    odd = odd.withColumn("source", F.lit("mixed.example"))
    got = language.accepted(base.unionByName(odd).withColumn("good", F.lit("mine")))
    rows = {r.doc_id: r for r in got.collect()}
    assert got.columns == [*base.columns, "good"]
    assert rows[9001].lang == "de" and len(rows) in (201, 202)
    assert language.accepted(base.limit(0)).count() == 0


# --- mixing ---------------------------------------------------------------


def water_filling(sizes, cap=3):
    """Targets of sources in order, excess reshared until none is above its limit."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: 1 + k % 3 for k, s in enumerate(names)}
    total, held = sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in held]
        rest = total - sum(held.values())
        share = {s: rest * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if share[s] > cap * sizes[s]]
        if not over:
            return {**held, **share}
        held.update({s: cap * sizes[s] for s in over})


def check_mix(rows, frame):
    source = {(r.doc_id, r.text): r.source for r in frame.collect()}
    sums, taken, least = {}, {}, {}
    for r in rows:
        s = source[r.doc_id, r.text]
        sums[s] = sums.get(s, 0) + r.size
        taken[s] = taken.get(s, 0) + r.copies * r.size
        if r.size:
            least[s] = min(least.get(s, r.size), r.size)
        assert 0 <= r.copies <= 3 and r.size == len((r.text or "").split())
    want = water_filling(sums)
    for r in rows:
        s = source[r.doc_id, r.text]
        assert r.source_size == sums[s] and r.target == pytest.approx(want[s])
    for s, target in want.items():
        assert abs(taken[s] - target) <= max(0.01 * target, 4 * least.get(s, 0))
    return want


def test_mix_of_the_table(spark):
    frame = spark.read.parquet(f"{SF}/documents.parquet")
    first, again = (
        sorted((r.doc_id, r.copies) for r in mixing.mixed(frame).collect()) for _ in range(2)
    )
    assert first == again
    check_mix(mixing.mixed(frame).collect(), frame)
    got = QUERIES["op9_entropy_mix"](spark, SF)
    assert got.count() == 200 and all(r.taken <= 3 * r.size for r in got.collect())


def test_mix_limits_nulls_ties_and_repeats(spark):
    rng = np.random.default_rng(2)
    rows = []
    for source, n, most in (("a", 60, 90), ("b", 4, 5), ("é", 30, 40), (None, 50, 60)):
        for _ in range(n):
            rows.append((len(rows), words(int(rng.integers(1, most))), source))
    rows += [(900, None, "a"), (901, "", "zz"), (902, None, None)]
    rows += [(903, words(20), "a")] * 40
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    frame = frame.withColumns({n: F.lit("mine") for n in ("n", "y", "r", "lam", "target", "seen")})
    mix = mixing.mixed(frame).collect()
    assert len(mix) == len(rows)
    want = check_mix(mix, frame)
    assert want["b"] == 3 * sum(r.size for r in mix if r.source == "b")
    assert {r.copies for r in mix if r.source == "b"} == {3}
    assert {r.copies for r in mix if r.size == 0} == {1} and want["zz"] == 0
    assert mixing.mixed(frame.limit(0)).count() == 0
    written = mixing.repeated(mixing.mixed(frame), ["doc_id", "text", "source"])
    assert written.count() == sum(r.copies for r in mix)


def test_rates_are_the_exponential_tilt(spark):
    """The dual solves the constraint, and larger documents differ by the same exponent."""
    rows = [(i, words(1 + i % 37), "s" + str(i % 3)) for i in range(900)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    sizes = mixing.sized(frame).groupBy("_mix_source", "_mix_size").agg(F.count("*").alias("n"))
    wanted = mixing.targets(sizes, (1, 2, 3), 3.0)
    dual = mixing.dual_values(sizes, wanted, 3.0)
    table = sizes.join(dual, "_mix_source").join(wanted, "_mix_source").toPandas()
    e = np.exp(table.lam * table._mix_size / table.scale)
    table["got"] = table.n * table._mix_size * 3 * e / (2 + e)
    per = table.groupby("_mix_source").agg(got=("got", "sum"), target=("target", "first"))
    assert np.allclose(per.got, per.target, rtol=1e-6)


# --- pipeline -------------------------------------------------------------


def test_stages_by_brute_force(spark, texts):
    frame = spark.read.parquet(f"{SF}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language", "near_duplicates", "paragraphs", "mix", "tokens"]
    held = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        frame = spark.createDataFrame(stage(spark, frame, SF).toPandas(), frame.schema)
        held.append(frame.toPandas())
    assert set(held[0].doc_id) == set(texts)  # nothing here is uncertain
    sets = {i: shingles(t) for i, t in texts.items()}
    root = roots(sets, similar_pairs(sets))
    assert sorted(held[1].doc_id) == sorted(set(root.values()))
    kept = {i: texts[i] for i in held[1].doc_id}
    cleaned = by_hand(kept)
    for r in held[2].itertuples():
        assert r.text == cleaned[r.doc_id][1] and r.n_chars == len(r.text)
    assert all(list(h.columns) == list(held[0].columns) for h in held)
    counts = held[3].groupby("doc_id").size()
    assert counts.max() <= 3 and set(counts.index) <= set(held[2].doc_id)
    tokens = corpus_pipeline.encode_texts(spark, frame, SF).toPandas()
    by_id = held[3].drop_duplicates("doc_id").set_index("doc_id").text
    assert len(tokens) == len(held[3])
    for r in tokens.itertuples():
        raw = by_id[r.doc_id].encode()
        assert r.decoded_sha256 == hashlib.sha256(raw).hexdigest() and len(r.ids) == r.n_tokens
    run = entry.queries()["pipeline"](spark, SF).toPandas()
    pd.testing.assert_frame_equal(
        *[t.drop(columns="ids").sort_values(["doc_id", "ids_sha256"], ignore_index=True)
          for t in (run, tokens)]
    )


def test_stages_on_odd_documents(spark):
    frame = docs(spark, [None, "", " ", LONG, "a", "a"]).withColumn("rid", F.lit("mine"))
    for name, stage in corpus_pipeline.STAGES:
        for given in (frame, frame.limit(0)):
            out = stage(spark, given, SF)
            if name != "tokens":
                assert out.columns == frame.columns
            rows = out.collect()
            assert rows or given is not frame or name == "near_duplicates"


def test_queries_are_registered_once_each():
    names = list(QUERIES)
    for n in range(1, 14):
        assert len([x for x in names if x.startswith(f"op{n}_")]) == 1
    assert set(names) | {"pipeline"} <= set(entry.queries())
