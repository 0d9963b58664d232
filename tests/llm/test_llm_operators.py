"""The llm operators: brute force, held-out accuracy, exact budgets, nulls, ties, empty tables and clashing columns."""

import datetime
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelloom.llm import abuse, leakage, mixing, survivors
from tests.conftest import plain
from tests.test_data_operators import rows_of

PANEL = "row_id long, year int, UNITID long, varnumber string, source_file string, value string, varTitle string, longDescription string, imputation_value string, loaded_at timestamp_ntz"
T0 = datetime.datetime(2020, 1, 1)


def panel(spark, rows):
    """rows: (row_id, unit, number, value, title, seconds or None)"""
    return spark.createDataFrame([(i, 2010, u, n, "S", v, t, None, None, None if s is None else T0 + datetime.timedelta(seconds=s)) for i, u, n, v, t, s in rows], PANEL)


# --- p3


def test_survivors_field_by_field(spark):
    df = panel(spark, [(1, 1, "1", "a", "t1", 5), (2, 1, " 00000001", "b", "nan", 9), (3, 1, "1", ".", "t3", 7), (4, 2, "1", "x", None, 1), (5, None, "1", "x", None, 1), (6, None, "1", "y", None, 2), (7, 3, "NA", "y", None, 2), (8, 3, "", "y", None, 3)])
    clash = df.select("*", F.lit("q").alias("VALUE"), F.lit(0).alias("n_rows"))
    for d in (df, clash):
        assert rows_of(survivors.choices(d), "group_row_id", "field", "row_id") == [(1, "value", 2), (1, "varTitle", 3)]
    got = {r.group_row_id: r for r in survivors.survivors(df).collect()}
    assert set(got) == {1, 4} and (got[1].value, got[1].varTitle, got[1].n_rows, got[4].value) == ("b", "t3", 3, "x")
    assert survivors.choices(df.limit(0)).count() == 0 and survivors.survivors(df.limit(0)).count() == 0


def test_survivor_ties_go_to_the_larger_row(spark):
    df = panel(spark, [(i, 1, "1", "v", None, 5) for i in (3, 9, 4)] + [(11, 1, "1", None, None, 99)])
    assert rows_of(survivors.choices(df), "field", "row_id") == [("value", 9)]


def test_currency_is_reasoned_without_dates(spark):
    """Held-out accuracy: values that follow a known order; dates are hidden in some groups."""
    rng = random.Random(4)
    stages = ["draft", "checked", "final", "revised", "closed"]
    rows, hidden, i = [], {}, 0
    for unit in range(80):
        picked = sorted(rng.sample(range(5), rng.randint(2, 4)))
        undated = unit >= 60
        ids = []
        for k, s in enumerate(picked):
            i += 1
            ids.append(i)
            rows.append((i, unit, "7", stages[s], None, None if undated else k))
        if undated:
            hidden[ids[0]] = ids[-1]
    rng.shuffle(rows)
    df = panel(spark, rows)
    got = {r.group_row_id: r.row_id for r in survivors.choices(df).collect()}
    assert np.mean([got[g] == want for g, want in hidden.items()]) >= 0.9
    assert len(got) == 80


def test_order_is_closed_transitively(spark):
    """draft < checked < final was learned from other groups; an undated {draft, final} is ordered through checked."""
    rows = [(1, 1, "7", "draft", None, 1), (2, 1, "7", "checked", None, 2), (3, 2, "7", "checked", None, 1), (4, 2, "7", "final", None, 2)]
    rows += [(5, 3, "7", "final", None, None), (6, 3, "7", "draft", None, None)]
    df = panel(spark, rows)
    got = {r.group_row_id: r.row_id for r in survivors.choices(df).collect()}
    assert got == {1: 2, 3: 4, 5: 5}
    assert {r.group_row_id: r.value for r in survivors.survivors(df).collect()} == {1: "checked", 3: "final", 5: "final"}


def test_hidden_dates_on_the_panel(spark, folder):
    """Of 30 % of the changing groups all dates are hidden: reasoned choices against the dated ones, where the order was learned."""
    df = spark.read.parquet(f"{folder}/panel_long.parquet")
    want = {(r.group_row_id, r.field): r.row_id for r in survivors.choices(df).collect()}
    unit = F.pmod(F.xxhash64("UNITID", "year", "varname"), F.lit(10)) < 3
    hidden = df.withColumn("loaded_at", F.when(~unit, F.col("loaded_at")))
    got = {(r.group_row_id, r.field): r.row_id for r in survivors.choices(hidden).collect()}
    assert got.keys() == want.keys()
    value = {r.row_id: (r.value, r.varTitle, r.longDescription, r.imputation_value) for r in df.collect()}
    at = {f: i for i, f in enumerate(survivors.FIELDS)}
    alike = [value[got[k]][at[k[1]]] == value[want[k]][at[k[1]]] for k in want]
    assert np.mean(alike) >= 0.9, np.mean(alike)


def test_cycles_still_have_a_survivor(spark):
    one = "group_row_id long, field string, varnumber string, v string, row_id long"
    cand = spark.createDataFrame([(1, "value", "7", v, i) for i, v in enumerate("abc")], one)
    edges = spark.createDataFrame([("7", "value", "a", "b", 5), ("7", "value", "b", "c", 2), ("7", "value", "c", "a", 1)], "varnumber string, field string, old string, new string, support long")
    assert rows_of(survivors.reasoned_choices(cand, edges), "group_row_id", "row_id") == [(1, 1)]
    assert rows_of(survivors.reasoned_choices(cand, edges.limit(0)), "group_row_id", "row_id") == [(1, 2)]


# --- p7

WORDS = [f"{a}{b}" for a in ("bar", "col", "dun", "fer", "gol", "hap", "jin", "kel", "lom", "nar") for b in ("ta", "mi", "ro", "su", "ve", "zo", "li", "pe", "qua", "ster")]


def corpus(seed=9):
    """Items, documents and the true pairs: stretches of at least 15 words with up to a fifth edited; runs of 8 are no case."""
    rng = random.Random(seed)
    items = [(k, " ".join(rng.choice(WORDS) for _ in range(70)), rng.choice(WORDS)) for k in range(12)]
    filler = lambda n: [rng.choice(["the", "report", "of", "unit", "row", "total", "and", "year", "has", "no"]) for _ in range(n)]
    docs, true = [], set()
    for d in range(140):
        text = filler(rng.randint(5, 60))
        if d % 2:
            k = rng.randrange(12)
            w = items[k][1].split()
            if d % 4 == 1:
                n = rng.randint(15, 60)
                a = rng.randrange(len(w) - n + 1)
                piece = w[a : a + n]
                for j in rng.sample(range(n), n // 5):
                    piece[j] = rng.choice(["", piece[j] + "x", "zzz"])
                piece = [p for p in piece if p]
                piece = [p.upper() if rng.random() < 0.3 else f"<b>{p}</b>" if rng.random() < 0.1 else p + rng.choice(["", ",", ".\n", "  "]) for p in piece]
                true.add((d, k))
            else:
                a = rng.randrange(len(w) - 8)
                piece = w[a : a + 8]
            text = text[:3] + piece + text[3:]
        docs.append((d, " ".join(text)))
    return items, docs, true


def test_leaks_equal_the_planted_pairs(spark):
    items, docs, true = corpus()
    i = spark.createDataFrame(items, "item_id long, text string, answer string")
    d = spark.createDataFrame([*docs, (900, None), (901, ""), (902, "x " * 50_000), (903, docs[1][1]), (None, docs[1][1])], "doc_id long, text string").select("*", F.lit("q").alias("TEXT"), F.lit(1).alias("ids"))
    found = {(r.doc_id, r.item_id) for r in leakage.leaks(d, i).where("kind = 'stretch'").collect()}
    assert found == true | {(903, k) for x, k in true if x == 1}
    # Blocks of items give the same pairs.
    again = {(r.doc_id, r.item_id) for r in leakage.leaks(d, i, leakage.Settings(block=5)).where("kind = 'stretch'").collect()}
    assert again == found
    assert leakage.leaks(d.limit(0), i).count() == 0 and leakage.leaks(d, i.limit(0)).count() == 0


def test_very_long_items_and_documents(spark):
    rng = random.Random(8)
    words = [f"w{rng.randrange(3000)}" for _ in range(3000)]
    long_doc = [f"w{rng.randrange(3000)}" for _ in range(60_000)]
    at = 45_000
    piece = words[1990:2010]
    piece[3] = piece[9] = piece[15] = "zz"
    docs = [(1, " ".join(long_doc)), (2, " ".join(long_doc[:at] + piece + long_doc[at:])), (3, " ".join(words[100:1500])), (4, " ".join(words[600:608]))]
    found = leakage.leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(7, " ".join(words), None)], "item_id long, text string, answer string"))
    got = {r.doc_id: r for r in found.collect()}
    assert set(got) == {2, 3} and got[2].stretch >= 15 and got[2].share >= 0.8


def test_retrieval_recall_against_brute_force(spark):
    """All documents against all items by alignment alone: the latent search must lose none of the pairs it finds."""
    items, docs, _ = corpus(31)
    s = leakage.Settings()
    block = leakage.Items.of([{"item_id": k, "text": t, "answer": a} for k, t, a in items])
    brute = set()
    for d, t in docs:
        ids = np.array([block.vocabulary.get(w, -1) for w in leakage.words(t)], dtype=np.int32)
        for k, place in enumerate(leakage.align([(x, ids) for x in block.texts], s) if len(ids) else []):
            if place is not None and leakage._stretch(place, s.agree, s)[0]:
                brute.add((d, k))
    i, d = spark.createDataFrame(items, "item_id long, text string, answer string"), spark.createDataFrame(docs, "doc_id long, text string")
    found = {(r.doc_id, r.item_id) for r in leakage.leaks(d, i, s).where("kind = 'stretch'").collect()}
    assert found == brute


def test_no_stretch_is_lost_among_rare_words(spark):
    """15-word stretches with 3 words replaced by unknown ones, in long foreign text: all found, whatever the weights."""
    rng = random.Random(5)
    common = [f"c{k}" for k in range(60)]
    items = [(k, " ".join(rng.choice(common) if rng.random() < 0.6 else f"w{rng.randrange(1500)}" for _ in range(90)), "") for k in range(60)]
    docs, true = [], set()
    for d in range(240):
        text = [rng.choice(common) if rng.random() < 0.4 else f"z{rng.randrange(10**6)}" for _ in range(120)]
        if d % 2 == 0:
            k, a = rng.randrange(60), rng.randrange(76)
            part = items[k][1].split()[a : a + 15]
            for j in rng.sample(range(1, 14), 3):
                part[j] = f"u{rng.randrange(10**6)}"
            text[50:65] = part
            true.add((d, k))
        docs.append((d, " ".join(text)))
    i, d = spark.createDataFrame(items, "item_id long, text string, answer string"), spark.createDataFrame(docs, "doc_id long, text string")
    block = leakage.Items.of([{"item_id": k, "text": t, "answer": a} for k, t, a in items])
    for n_docs in (240, 100_000):
        docs_ = leakage.numbered(d, block.vocabulary)
        weights, outside = leakage.weights_of(docs_, n_docs, len(block.vocabulary))
        s = leakage.Settings()
        vectors = leakage.latent_words(docs_, block, weights, s)
        found = {(r.doc_id, r.item_id) for r in leakage.search(docs_, block, weights, outside, vectors, s).collect()}
        assert true <= found


def test_latent_bound_loses_no_pair_of_windows():
    """Latent product plus residual product against the full cosine of all pairs, at a rank far below the vocabulary."""
    rng = np.random.default_rng(3)
    weights = (1 + rng.random(60)).astype(np.float32)
    vectors = np.linalg.qr(rng.standard_normal((60, 5)))[0].astype(np.float32)
    ids = [rng.integers(-2, 60, size=(200, 16)).astype(np.int32) for _ in range(2)]
    a, b = (leakage.Bank(x, weights, 2.0, vectors) for x in ids)
    dense = []
    for x in ids:
        full = np.zeros((200, 60))
        for k in range(200):
            for w in x[k][x[k] >= 0]:
                full[k, w] += weights[w]
        dense.append(full / np.sqrt((full**2).sum(axis=1) + 4.0 * (x == -1).sum(axis=1))[:, None])
    want = dense[0] @ dense[1].T
    x, y, cos = a.near(b, 0.3)
    assert np.allclose(cos, want[x, y], atol=1e-4)
    assert set(zip(x.tolist(), y.tolist())) >= set(zip(*(z.tolist() for z in np.nonzero(want > 0.3001))))


def test_gram_is_the_product_of_the_passage_matrix(spark):
    docs = [(1, [0, 1, 1, -1, 2, 3]), (2, [3, -1]), (3, [2])]
    weights = np.array([1, 1.5, 2, 1.2], dtype=np.float32)
    got = np.zeros((4, 4))
    for r in leakage.gram(spark.createDataFrame(docs, "doc_id long, ids array<int>"), weights, 4).collect():
        got[r.w, r.v] = r.g
    a = np.array([[1, 3, 0, 0], [0, 0, 2, 1.2], [0, 0, 0, 1.2], [0, 0, 2, 0]])
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    assert np.allclose(got, a.T @ a, atol=1e-6)


def test_paraphrases_need_the_answer(spark):
    rng = random.Random(2)
    item = rng.sample(WORDS, 40)
    near = item[5:25]
    for j in (1, 4, 7, 10, 13, 16):
        near[j] = "zz"
    d = spark.createDataFrame([(1, " ".join(near)), (2, " ".join([*near, "bingo"])), (3, " ".join([*item[:8], "bingo"]))], "doc_id long, text string")
    i = spark.createDataFrame([(7, " ".join(item), "Bingo!")], "item_id long, text string, answer string")
    got = [(r.doc_id, r.kind, r.answer_found) for r in leakage.leaks(d, i).collect()]
    assert got == [(2, "paraphrase", True)]


def test_long_tags_are_no_words():
    assert leakage.words("one <a href='" + "x y " * 200 + "'>two</a> 3 < 4 and 5 > 4") == ["one", "two", "3", "4", "and", "5", "4"]


def test_latent_words_are_orthonormal(spark):
    items, docs, _ = corpus()
    block = leakage.Items.of([{"item_id": k, "text": t, "answer": a} for k, t, a in items])
    d = leakage.numbered(spark.createDataFrame(docs, "doc_id long, text string"), block.vocabulary)
    weights, _ = leakage.weights_of(d, len(docs), len(block.vocabulary))
    v = leakage.latent_words(d, block, weights, leakage.Settings(rank=20))
    assert v.shape == (len(block.vocabulary), 34) and np.allclose(v.T @ v, np.eye(34), atol=1e-4)  # a third of the vocabulary


def test_words():
    assert leakage.words("The <b>Café's</b>&nbsp;re-\nport­, No. 5") == ["the", "cafes", "report", "no", "5"]
    assert leakage.words(None) == [] == leakage.words("")


# --- p8


def test_mix_hits_every_budget(spark):
    docs = [(i, "word " * (1 + i % 9), "big" if i % 3 else " Small-src ") for i in range(300)] + [(900, None, "big"), (901, "", "big"), (902, "x", "other"), (903, "x", None)]
    d = spark.createDataFrame(docs, "doc_id long, text string, source string").select("*", F.lit(3).alias("SOURCE_"), F.lit(1).alias("before"))
    t = spark.createDataFrame([("BIG", 0.4, 1), ("small_src", 0.5, 3), ("none", 0.1, 2)], "source string, target_share double, max_repeats int")
    rows = mixing.mix(d, t).collect()
    plan = {r.source: r for r in mixing.shares(d, t).collect()}
    assert {r.source for r in rows} == {"big", "small_src"} and len({r.doc_id for r in rows}) == len(rows)
    for s in ("big", "small_src"):
        mine = [r for r in rows if r.source == s]
        used = sum(r.n_tokens * r.repeats for r in mine)
        longest = max(r.n_tokens for r in mine)
        assert used == plan[s].tokens and plan[s].budget - longest < used <= plan[s].budget
        assert max(r.repeats for r in mine) <= plan[s].max_repeats
        # The last epoch takes a prefix in the order of the keys.
        ordered = sorted(mine, key=lambda r: (r.order_key, r.doc_id))
        assert [r.repeats for r in ordered] == sorted((r.repeats for r in ordered), reverse=True)
        assert abs(plan[s].reached_share - plan[s].share_among_present) < 0.01
    assert plan["none"].tokens == 0 and plan["none"].reached_share == 0
    again = mixing.mix(d.repartition(5), t).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))


def test_mix_caps_and_empty_tables(spark):
    d = spark.createDataFrame([(1, "a b c", "s"), (2, "a b", "t")], "doc_id long, text string, source string")
    t = spark.createDataFrame([("s", 0.5, 2), ("t", 0.5, 0)], "source string, target_share double, max_repeats int")
    assert rows_of(mixing.mix(d, t, total=1000), "doc_id", "repeats") == [(1, 2)]
    assert mixing.mix(d.limit(0), t).count() == 0 and mixing.mix(d, t.limit(0)).count() == 0
    assert mixing.shares(d.limit(0), t).count() == 2


def test_tokens_are_those_of_the_public_tokenizer(spark):
    tok = pytest.importorskip("tokenizers").Tokenizer.from_file("/opt/tokenizers/byte_bpe_50k.json")
    tok.encode_special_tokens = True
    texts = ["It's 2,019 cafés\n\n  now", "<|endoftext|>", "", "x" * 5000]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = {r.i: r.n for r in df.select("i", mixing.token_count()(F.col("t")).alias("n")).collect()}
    assert got == {i: len(tok.encode(t, add_special_tokens=False).ids) for i, t in enumerate(texts)}


# --- p9


def test_hidden_spellings():
    for text in ("f u c k you", "F.U.C.K you", "f**k you", "fuckkkk you", "fúck you".replace("́", "")):
        assert "fuck" in abuse.tokens(text)[0], text
    assert abuse.tokens("you f1lthy r@t")[0] == ["you", "filthy", "rat"] and abuse.tokens("you f1lthy r@t")[2] == 2
    assert abuse.tokens("room 101, e.g. 2019")[2] == 0


def test_nearest_places_without_a_size_switch():
    rng = random.Random(0)
    for _ in range(200):
        a, b = (sorted(rng.sample(range(400), rng.randint(1, 30))) for _ in range(2))
        assert abuse._nearest(a, b) == 1 / (1 + min(abs(x - y) for x in a for y in b) / 4)
    assert abuse._nearest(list(range(100)), list(range(5000, 5100))) == 1 / (1 + 4901 / 4) and abuse._nearest([], [1]) == 0


def test_judged_documents_are_scored_by_the_other_half():
    x = np.zeros((1, len(abuse.FEATURES) - 2), dtype=np.float32)
    trees = [abuse.Trees(m, 1.0, []) for m in (-2.0, 3.0)]
    model = abuse.Model([{}, {}], trees, (np.array([-5.0, 5.0]), np.array([0.0, 1.0])))
    docs = [(x, [np.zeros((1, 2), np.float32)] * 2)] * 3
    assert np.allclose(model.probabilities(docs, [0, 1, None]), [0.8, 0.3, 0.55])
    assert np.allclose([model.probability(*docs[0], h) for h in (0, 1, None)], [0.8, 0.3, 0.55])


def test_accuracy_on_held_out_judgements(spark, folder):
    """Real documents: every judged one is scored by the model that has not seen it. A few judgements are wrong."""
    d = folder.replace("sf0.001", "sf0.01")
    docs, labels = (spark.read.parquet(f"{d}/{n}.parquet") for n in ("documents", "doc_labels"))
    got = {r.doc_id: r.offensive for r in abuse.scores(docs, labels).collect()}
    rows = [(r.y, got[r.doc_id]) for r in abuse.judged(labels).collect() if r.doc_id in got]
    assert np.mean([bool(y) == g for y, g in rows]) >= 0.9


def test_isotonic_is_monotone():
    rng = np.random.default_rng(0)
    s = rng.normal(size=200)
    xs, ps = abuse.isotonic(s, (rng.random(200) < 1 / (1 + np.exp(-2 * s))).astype(float))
    assert (np.diff(xs) >= 0).all() and (np.diff(ps) >= 0).all() and 0 <= ps.min() and ps.max() <= 1


def test_boosting_learns_an_interaction():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 2, size=(400, len(abuse.FEATURES))).astype(np.float32)
    y = ((x[:, 0] == 1) & (x[:, 1] == 1)).astype(float)
    p = abuse.boost(x, y, np.ones(len(y))).margin(x) > 0
    assert (p == (y == 1)).mean() > 0.98


OFFENSIVE = [
    "You are a stupid bastard and everyone knows it.", "I will break your fingers, you filthy rat.", "All foreigners are vermin and must go.", "Send me nudes, you horny slut.",
    "Drop dead, you worthless idiot.", "Go fuck yourself, moron.", "Nobody likes you, pathetic loser.", "Keep the natives out, they are subhuman filth.",
]
HARMLESS = [
    "The code of conduct bans insults and threats.", "Damn, the check failed again.", "My own stupid fault, sorry.", "Report sex as recorded on the form.", "The build killed one job.",
    "The breast screening course has 30 places.", "See the total of the staff file.", "Please send the form again.",
]


def test_held_out_accuracy(spark):
    rng = random.Random(6)
    docs, labels, truth = [], [], {}
    for i in range(360):
        bad = i % 3 == 0
        lines = [rng.choice(HARMLESS) for _ in range(rng.randint(1, 5))] + ([rng.choice(OFFENSIVE)] if bad else [])
        rng.shuffle(lines)
        docs.append((i, " ".join(lines), rng.choice(["forum", " Forum", None])))
        truth[i] = bad
        if i < 200:
            labels += [(i, 1, int(bad ^ (rng.random() < 0.03)))]
    docs += [(900, None, "forum"), (901, "", "forum"), (902, "long words " * 20_000, "forum")]
    d = spark.createDataFrame(docs, "doc_id long, text string, source string").select("*", F.lit("q").alias("TEXT"), F.lit(True).alias("offensive"))
    lab = spark.createDataFrame([*labels, (900, 1, None), (12345, 1, 1)], "doc_id long, rater int, offensive int")
    got = {r.doc_id: r for r in abuse.scores(d, lab).collect()}
    assert len(got) == 363 and not any(got[i].offensive for i in (900, 901, 902))
    assert np.mean([got[i].offensive == truth[i] for i in range(200, 360)]) >= 0.97
    r = {x.source: x for x in abuse.rates(abuse.scores(d, lab)).collect()}
    assert sum(x.n_docs for x in r.values()) == 363 and set(r) == {"forum", None}


def test_labelled_sample_is_bounded(spark):
    rows = spark.range(5000).select(F.col("id").alias("doc_id"), F.lit(1).alias("y"))
    few = {r.doc_id for r in abuse.choose(rows, 500).collect()}
    assert len(few) == 500 and few == {r.doc_id for r in abuse.choose(rows.repartition(7), 500).collect()}
    assert abuse.choose(rows, 10_000).count() == 5000


def test_few_or_no_labels(spark):
    d = spark.createDataFrame([(1, OFFENSIVE[1], "s"), (2, HARMLESS[0], "s")], "doc_id long, text string, source string")
    none = spark.createDataFrame([], "doc_id long, rater int, offensive int")
    assert rows_of(abuse.scores(d, none), "doc_id", "offensive") == [(1, True), (2, False)]
    assert abuse.scores(d.limit(0), none).count() == 0


# --- queries


def test_queries_match_their_sql(spark, folder, oracle):
    from collections import Counter

    from panelloom.llm import queries

    for name, sql in queries.ORACLES.items():
        df = queries.QUERIES[name](spark, folder)
        names = sorted(df.columns)
        rel = oracle.execute(sql)
        at = [[c[0] for c in rel.description].index(c) for c in names]
        assert Counter(tuple(plain(r[c]) for c in names) for r in df.collect()) == Counter(tuple(plain(r[i]) for i in at) for r in rel.fetchall()), name


@pytest.mark.parametrize("name", ["p7_found", "p8_shares", "p9_rates"])
def test_queries_run(spark, folder, name):
    from panelloom.llm import queries

    assert queries.QUERIES[name](spark, folder).count() >= 0
