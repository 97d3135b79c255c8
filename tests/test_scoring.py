import random
from datetime import date

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from feedloom.functions import phrases, scoring
from feedloom.functions.scoring import cents, score_articles, with_stages
from feedloom.operators import terms as term_search
from feedloom.operators.terms import list_hits, occurring, term_hits
from feedloom.settings import DEPLOYED_WEIGHTS, Lexicon, Weights

DAY = date(2024, 5, 1)


def scored(articles, *rows, weights=Weights(), lexicon=Lexicon()):
    made = articles([(DAY, i, t, f"u{i}", s, c, None) for i, (t, s, c) in enumerate(rows)])
    return score_articles(made, weights, lexicon).orderBy("seq").collect()


def test_frontier_article_beats_share_price_article(articles):
    frontier, finance = scored(
        articles,
        ("Agents automate merchant workflow", "A new dashboard for analytics and automation", "AI Frontier"),
        ("Shares fall after earnings", "", "Product & Startup Signals"),
    )
    assert frontier.total > finance.total
    assert frontier.pm_relevance >= 4 and frontier.actionability >= 3
    assert finance.impact == 1 and finance.actionability == 1


def test_ladder_has_five_rungs(articles):
    lexicon = Lexicon(score_terms={c: tuple(f"t{i}x" for i in range(9)) for c in ("impact", "novelty", "pm_relevance", "actionability")})
    rows = [(" ".join(f"t{i}x" for i in range(n)), "", "Other") for n in range(9)]
    assert [r.impact for r in scored(articles, *rows, lexicon=lexicon)] == [1, 2, 2, 3, 3, 4, 4, 4, 5]


def test_finance_words_need_boundaries_and_no_product_word(articles):
    rows = [("launch stockpile", "", "Other"), ("launch of stock", "", "Other"), ("global ads stock growth opens", "", "Other"), ("全球 global growth 股价", "", "Other")]
    impacts = [r.impact for r in scored(articles, *rows)]
    assert impacts == [2, 2, 3, 1]


def test_category_bonus_and_labels(articles):
    shop, china, signal = scored(
        articles, ("x", "", "E-commerce & Marketplace"), ("x", "", "China Tech & Retail"), ("seller copilot rag", "", "Product & Startup Signals")
    )
    assert shop.pm_relevance == 3 and "Marketplace" in shop.keywords
    assert china.keywords == ["China Tech"]
    assert signal.keywords == ["AI Copilot", "Seller Tools", "RAG", "Product Signal"]


def test_five_labels_cut_the_category_label(articles):
    (row,) = scored(articles, ("agent copilot workflow dashboard advertising", "", "China Tech & Retail"))
    assert row.keywords == ["AI Agent", "AI Copilot", "AI Workflow", "AI Analytics", "Retail Media"]


def test_weights_from_config(articles):
    weights = Weights.from_config({"impact": 1.0, "novelty": 0})
    assert (weights.impact, weights.novelty, weights.source_quality) == (1.0, 0.0, 0.20)
    (row,) = scored(articles, ("launch", "", "Other"), weights=Weights(1.0, 0.0, 0.0, 0.0, 0.0))
    assert row.total == 2.0
    assert Weights.from_config(None) == Weights()
    assert abs(sum(vars(DEPLOYED_WEIGHTS).values()) - 1) < 1e-9


def test_total_is_the_weighted_sum(articles):
    (row,) = scored(articles, ("launch of a new tool", "for sellers", "AI Frontier"), weights=DEPLOYED_WEIGHTS)
    parts = {c: row[c] for c in vars(DEPLOYED_WEIGHTS)}
    assert row.total == round(sum(getattr(DEPLOYED_WEIGHTS, c) * v for c, v in parts.items()), 2)
    assert all(1 <= v <= 5 for v in parts.values())


def test_stages(articles):
    made = articles([(DAY, 0, "Checkout data", "u", "traffic", "x", None), (DAY, 1, "nothing", "u", "", "x", None)])
    rows = with_stages(made).orderBy("seq").collect()
    assert [r.stages for r in rows] == ["流量/广告、转化、数据分析", "选品、流量、转化、数据分析"]


def test_item_texts(spark):
    frame = spark.createDataFrame([("x" * 221, "t", 4.2, []), ("", "title", 3.0, ["RAG", "Retail Media"]), ("s", "t", 2.65, ["AI Agent"])], "s string, t string, n double, k array<string>")
    rows = frame.select(
        phrases.short_summary(F.col("s"), F.col("t")).alias("short"), phrases.priority(F.col("n")).alias("p"),
        phrases.number_text(F.col("n")).alias("n"), phrases.keyword_notes(F.col("k")).alias("notes"), phrases.takeaway(F.col("k")).alias("take"),
    ).collect()
    assert rows[0].short == "x" * 220 + "..." and rows[1].short == "title"
    assert [r.p for r in rows] == ["High", "Medium", "Low"] and [r.n for r in rows] == ["4.2", "3.0", "2.65"]
    assert rows[0].notes.startswith("Marketplace：") and rows[1].notes.startswith("RAG：检索")
    assert rows[1].take.startswith("不要只把") and rows[2].take.startswith("商家工作台")


def test_totals_are_rounded_by_their_binary_value(spark, articles):
    values = [2.675, 0.125, 0.375, 2.665, 1.005, 0.015, 1023.995, 1024.005, 0.0, 1e-9, 3.3349999999999995, -2.675] + [i / 200 for i in range(1000)]
    found = spark.createDataFrame([(v,) for v in values], "v double").select("v", cents(F.col("v")).alias("c")).collect()
    assert [r.c for r in found] == [round(r.v, 2) for r in found]
    assert (found[0].c, found[1].c, found[4].c) == (2.67, 0.12, 1.0)
    weights = Weights(0.335, 0.265, 0.2, 0.1, 0.1)
    for r in scored(articles, ("Agents automate workflow", "dashboard analytics", "AI Frontier"), ("x", "", "Other"), weights=weights):
        exact = r.impact * 0.335 + r.novelty * 0.265 + r.source_quality * 0.2 + r.pm_relevance * 0.1 + r.actionability * 0.1
        assert r.total == round(exact, 2)


def test_joined_terms_equal_written_out_ones(spark, articles, monkeypatch):
    rows = [(f"agent wörkflow {i} seller", "retail media " * i + "x" * (i * 37) + " dashboard", c) for i, c in enumerate(["AI Frontier", "Other", "E-commerce & Marketplace"] * 4)]
    want = scored(articles, *rows)
    monkeypatch.setattr(scoring, "WRITTEN_OUT", 0)
    assert [r.asDict() for r in scored(articles, *rows)] == [r.asDict() for r in want]


@pytest.mark.parametrize("window", [7, 64, 1 << 20])
def test_occurring_against_plain_search(monkeypatch, window):
    monkeypatch.setattr(term_search, "WINDOW", window)
    rng = random.Random(3)
    for _ in range(30):
        texts = ["".join(rng.choices("abé 智", k=rng.choice([0, 1, 3, 30, 200]))).encode() for _ in range(rng.choice([0, 1, 30]))]
        words = list({"".join(rng.choices("abé 智", k=rng.choice([0, 1, 2, 3, 4, 8]))).encode() for _ in range(30)})
        found = occurring(pa.array([b"ab", *texts], pa.binary()).slice(1), words)
        assert found.tolist() == [[w in t for w in words] for t in texts]


def test_list_hits(spark):
    lists = [["ab", "b", "ab", "智"], [], ["", "x y"]]
    frame = spark.createDataFrame([(0, "ab 智"), (1, ""), (2, "x"), (3, "yx y")], "id int, text string")
    found = frame.select("id", list_hits(F.col("text"), lists).alias("n")).collect()
    assert {r.id: r.n for r in found} == {0: [4, 0, 1], 1: [0, 0, 1], 2: [0, 0, 1], 3: [0, 0, 2]}


def test_a_longer_lexicon_adds_no_search_of_the_text(articles):
    """Only the words of the finance rule are searched one by one."""
    made = articles([(DAY, 0, "t", "u", "s", "Other", None)])
    lexicon = Lexicon(score_terms={c: tuple(f"{c}{i}" for i in range(90)) for c in ("impact", "novelty", "pm_relevance", "actionability")})
    plans = [score_articles(made, lexicon=x)._jdf.queryExecution().optimizedPlan().toString() for x in (Lexicon(), lexicon)]
    words = len(lexicon.finance_words) + len(lexicon.product_words)
    assert all(0 < plan.count("Contains(") <= words for plan in plans)


def test_term_hits_against_plain_search(spark):
    rng = random.Random(2)
    texts = ["".join(rng.choices("abcé ", k=rng.choice([0, 3, 50, 700, 3000]))) for _ in range(40)]
    words = {"".join(rng.choices("abcé ", k=rng.choice([1, 2, 3, 4, 5, 6, 9, 300]))) for _ in range(400)} | {texts[5][200:500], "", texts[7][:1]}
    terms = [(f"g{len(w) % 3}", w) for w in words] + [("g9", "ab"), ("g9", "ab")]
    found = term_hits(
        spark.createDataFrame([*enumerate(texts), (99, None)], "id int, text string"), spark.createDataFrame(terms, "group string, term string"), ["id"]
    )
    want = {(i, g): len({w for h, w in terms if h == g and w and w in t}) for i, t in enumerate(texts) for g, _ in terms}
    assert {(r.id, r.group): r.hits for r in found.collect()} == {k: n for k, n in want.items() if n}
