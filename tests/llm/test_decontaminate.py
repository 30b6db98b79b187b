import re

import nasty
from conftest import SF

from streamlytics.llm.decontaminate import WINDOW, leaks, template, tokens, without_leaks

ITEMS = [
    (1, "A train leaves Paris at 9 and drives 120 km in 3 hours, so how fast does it go on average?"),
    (2, "Name the five longest rivers."),
    (3, "two words"),
    (4, None),
    (5, "Which of the following statements about Alice and Bob and Alice is true in every case?"),
]
FILL = "some words that stand before and after the passage in question here "


def frames(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    return docs, spark.createDataFrame(ITEMS, "item_id bigint, text string")


def found(spark, texts):
    return sorted((r.doc_id, r.item_id) for r in leaks(*frames(spark, texts)).collect())


def test_tokens_and_templates_line_up(spark):
    texts = [t for _, t in ITEMS] + [r[1] for r in nasty.ROWS] + ["a<b 3.5 kg <num> 1,000 x_y 5km; Then He Said: 7", "<<", "3"]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    got = df.select(tokens(df.text).alias("a"), template(df.text).alias("b")).collect()
    assert all(len(r.a or []) == len(r.b or []) for r in got)
    assert got[0].b[:11] == "a train leaves <name> at <num> and drives <num> <unit> in".split()


def test_copies_and_new_parameters_are_caught(spark):
    exact = FILL + ITEMS[0][1] + " " + FILL
    changed = FILL + ITEMS[0][1].replace("120", "95.5").replace("9", "8", 1).replace("Paris", "Rome") + FILL
    renamed = FILL + ITEMS[4][1].replace("Alice", "Carol").replace("Bob", "Dan") + FILL
    mixed_up = FILL + "Which of the following statements about Carol and Dan and Erin is true in every case?"
    short = "Name the five longest rivers."
    clean = FILL * 30 + "A train leaves the town at noon."
    assert found(spark, [exact, changed, renamed, short, clean, exact.upper()]) == [(0, 1), (1, 1), (2, 5), (3, 2)]
    # One name for two different ones: below full consistency.
    docs, items = frames(spark, [mixed_up, renamed])
    assert [(r.doc_id, r.consistency) for r in leaks(docs, items, consistency=0.99).collect()] == [(1, 1.0)]


def test_awkward_rows(spark):
    docs = nasty.docs(spark)
    items = spark.createDataFrame([(1, nasty.ROWS[0][1], "x"), (1, None, "x")], "item_id bigint, text string, source string")
    assert sorted(r.doc_id for r in leaks(docs, items).collect()) == [1, 2]
    left = without_leaks(docs, items)
    assert left.columns == docs.columns and left.count() == len(nasty.ROWS) - 2
    assert leaks(docs, items.limit(0)).count() == 0 and without_leaks(docs, items.limit(0)).count() == len(nasty.ROWS)
    assert leaks(nasty.empty(spark), items).count() == 0


def plain(docs, items):
    """Coverage by sets of windows; the given tables hold no slots but sentence-inner capitals."""
    number = lambda t: re.sub(r"(?<=\d)[.,](?=\d)", "_", t)

    def cut(t):
        t = re.sub(r"(?<=[^\W\d_A-ZÀ-ÞŒ] )[A-ZÀ-ÞŒ]\w*", "<name>", number(t)) if False else t
        return re.findall(r"\w+", t.lower())

    windows = lambda w: {tuple(w[i : i + WINDOW]) for i in range(len(w) - WINDOW + 1)}
    known = {i: windows(cut(t)) for i, t in items}
    out = []
    for d, t in docs:
        own = windows(cut(t or ""))
        out += [(d, i) for i, w in known.items() if len(own & w) >= 0.5 * len(w)]
    return sorted(out)


def test_given_tables(spark):
    docs, items = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    got = sorted((r.doc_id, r.item_id) for r in leaks(docs, items).collect())
    want = plain([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()])
    assert got == want and want


def caught(spark, texts, items, **options):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    bench = spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string")
    return sorted((r.doc_id, r.item_id) for r in leaks(docs, bench, **options).collect())


def test_names_that_begin_sentences(spark):
    apples = "Anna has 12 apples. Anna buys 5 more. How many apples does Anna have?"
    texts = [FILL + apples.replace("Anna", "Bob"), "here is the question Name the five longest rivers.", "ALL CAPITALS " * 20]
    items = [apples, "Name the five longest rivers.", "NO WORD OF THIS IS WRITTEN IN SMALL LETTERS"]
    assert caught(spark, texts, items) == [(0, 0), (1, 1)]


def test_one_changed_word_and_long_runs(spark):
    words = [f"w{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(200)]
    texts, items, at = [], [], 0
    for n in (9, 12, 16, 17, 22):
        item, at = words[at : at + n], at + n
        items.append(" ".join(item))
        texts.append(FILL + " ".join([*item[: n // 2], "other", *item[n // 2 + 1 :]]) + " end")
    long = [w.replace("w", "v") for w in words]
    texts += [" ".join(long[60:140]), " ".join(long[60:80])]
    assert caught(spark, texts, [*items, " ".join(long)]) == [(i, i) for i in range(6)]


def test_copies_in_other_case(spark):
    item = "The train from Paris to Rouen stops in Le Havre, then in Caen, before 12 km of Norman coast."
    texts = [item.upper(), item.lower(), FILL]
    assert caught(spark, texts, [item], any_case=True) == [(0, 0), (1, 0)]
