"""Benchmark leaks found through templates: numbers, names and units count as typed slots.

A text is cut into tokens, and a token that is a number, a unit after a number, or a capitalised
word inside a sentence is replaced by its type. Windows of ``WINDOW`` template tokens are hashed
and joined with those of the benchmark. That also finds questions whose numbers or names were
exchanged; a real one uses one new value for each old one, so along each alignment of document
and item the slot values are checked for consistency.

Which words are names is told in several views, each on both sides, and a leak in one is a leak:
capitals inside sentences; all capitals, whatever stands before them; and, with ``any_case``, none.
A leak holds enough of the item's windows, or of its tokens along one alignment, or a long run.

The types come from a few whole-text patterns, applied once for all views. Of the places in a text
only those are looked at closer where the next three tokens are the first of an item's window; windows of
all widths and views are hashed and joined there in one pass. Nothing leaves the JVM.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streamlytics.llm.common import written
from streamlytics.operators.enrich import broadcast_if_few

WINDOW = 8
#: Items with fewer tokens say little: their slots must be equal too, and those with fewer than
#: LEAST_INSIDE tokens must be the whole text.
LEAST_TOKENS, LEAST_INSIDE = 5, 3
#: Items under SHORT tokens are looked for by windows of SHORT_WINDOW, and need SHORT_MORE coverage.
SHORT, SHORT_WINDOW, SHORT_MORE = 16, 4, 0.1
COVERAGE = 0.5
#: So many tokens along one alignment are a leak, however long the item is.
RUN = 30
CONSISTENCY = 0.8
#: Rows of 16 bytes; beyond that the benchmark is shuffled instead.
BROADCAST_WINDOWS = 1_000_000

# Units that count as a slot after a number.
UNITS = """
mm cm m km mg g kg t ml l s min h ms hz kb mb gb tb w kw kwh v a j kj cal kcal pa bar
inch inches foot feet yard yards mile miles ounce ounces pound pounds gallon gallons
meter meters metre metres kilometer kilometers kilogram kilograms gram grams liter liters litre
litres second seconds minute minutes hour hours day days week weeks month months year years
dollar dollars euro euros cent cents percent degree degrees
zoll fuß meile meilen gramm sekunde sekunden minuten stunde stunden tag tage tagen woche wochen
monat monate monaten jahr jahre jahren prozent grad mètre mètres kilomètre kilomètres gramme grammes
kilogramme kilogrammes litres seconde secondes heure heures jour jours semaine semaines mois an ans
année années degré degrés metro metros kilómetro kilómetros gramo gramos kilogramo kilogramos
litro litros segundo segundos minuto minutos hora horas día días semana semanas mes meses año años
dólar dólares céntimo céntimos grado grados
""".split()

INNER, CAPITALS, PLAIN = range(3)
ALL = -1
NUMBER, NAME, UNIT = "<num>", "<name>", "<unit>"

# Signs that stand for slots, and before words with a capital, while a text is cut. Texts may not
# hold them; there they end a word like any other control sign.
_INNER, _CAPITAL, _NUMBER, _UNIT, _CAPITAL_UNIT, _NAME = (chr(c) for c in range(1, 7))
_SIGNS = _INNER + _CAPITAL + _NUMBER + _UNIT + _CAPITAL_UNIT + _NAME
_W = r"[\p{L}\p{N}_]"


def tokens(text: Column) -> Column:
    """Runs of letters and digits; a point or comma between digits belongs to the number."""
    joined = F.regexp_replace(text, r"(?<=\d)[.,](?=\d)", "_")
    cleaned = F.trim(F.regexp_replace(joined, r"[^\p{L}\p{N}_]+", " "))
    return F.filter(F.split(cleaned, " "), lambda t: t != "")


def _cut(text: Column) -> Column:
    """The tokens in small letters, numbers and units as signs, and a sign before each word that had a
    capital; as many as ``tokens``. Every pattern looks for rare characters, so a text is passed quickly.
    """
    # The only capital whose small form has two characters, one of which ends a word.
    own = F.translate(text, _SIGNS + "\u0130", "\n" * len(_SIGNS) + "I")
    text = F.when(F.rlike(text, F.lit(f"[{_SIGNS}\u0130]")), own).otherwise(text)
    marked = F.regexp_replace(text, r"[.,](?<=\d.)(?=\d)", "_")
    marked = F.regexp_replace(marked, rf"(\p{{Lu}})(?<!{_W}.)", f"{_CAPITAL}$1")
    # A capital after a small letter, a comma or a digit and one blank starts no sentence.
    marked = F.regexp_replace(marked, rf"{_CAPITAL}(?<=[\p{{Ll}}\d,;] .)", _INNER)
    marked = F.regexp_replace(marked, rf"\d(?<!{_W}\d)[\d_]*(?!{_W})", _NUMBER)
    units = "|".join(sorted(UNITS, key=len, reverse=True))
    marked = F.regexp_replace(marked, rf"{_NUMBER} (?iu:{units})(?!{_W})", f"{_NUMBER} {_UNIT}")
    marked = F.regexp_replace(marked, rf"{_NUMBER} {_INNER}(?iu:{units})(?!{_W})", f"{_NUMBER} {_CAPITAL_UNIT}")
    return F.array_remove(F.split(F.lower(marked), rf"[^\p{{L}}\p{{N}}_{_SIGNS}]+"), "")


def _seen(token: Column, view: Column | int) -> Column:
    """A token of ``_cut`` as one view has it."""
    view = F.lit(view) if isinstance(view, int) else view
    name = (view == CAPITALS) | ((view == INNER) & (token < _CAPITAL))
    return (
        F.when(~_has_capital(token), token)
        .when(token == _CAPITAL_UNIT, F.when(view == PLAIN, _UNIT).otherwise(_NAME))
        .when(name, _NAME)
        .otherwise(F.substr(token, F.lit(2)))
    )


def _has_capital(token: Column) -> Column:
    """Whether views differ in a token."""
    return (token < _NUMBER) | (token == _CAPITAL_UNIT)


def template(text: Column, view: int = INNER) -> Column:
    """The same tokens in small letters, slots replaced by their type; as many as ``tokens``."""
    types = {_NUMBER: NUMBER, _UNIT: UNIT, _NAME: NAME}
    named = lambda t: reduce(lambda c, k: F.when(t == k, types[k]).otherwise(c), types, t)
    return F.transform(F.transform(_cut(text), lambda t: _seen(t, view)), named)


def _begin(three: list[Column]) -> Column:
    """A hash of the tokens a window begins with, null ones being behind the end."""
    return F.xxhash64(*three)


def _three() -> list[Column]:
    return [F.get("tokens", F.col("pos") + i) for i in range(LEAST_INSIDE)]


def _places(docs: DataFrame, views: list[int]) -> DataFrame:
    """(doc_id, text_key, tokens, pos, of, begin) of every place in a text: one row where all views
    have the same three tokens there, ``of`` being ``ALL``, or else one row for each view."""
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_key"), _cut(F.col("text")).alias("tokens"))
    # The outer forms infer no filter on the array, which would cut every text a second time.
    rows = rows.select("*", F.posexplode_outer("tokens").alias("pos", "token"))
    names = [f"t{i}" for i in range(LEAST_INSIDE)]
    rows = rows.withColumns(dict(zip(names, [F.col("token"), *_three()[1:]], strict=True)))
    differ = reduce(lambda x, y: x | y, [F.coalesce(_has_capital(F.col(t)), F.lit(False)) for t in names])
    each = F.when(differ, F.array(*map(F.lit, views))).otherwise(F.array(F.lit(ALL)))
    rows = rows.withColumn("of", F.explode_outer(each))
    begin = _begin([_seen(F.col(t), F.col("of")) for t in names]).alias("begin")
    return rows.select("doc_id", "text_key", "tokens", "pos", "of", begin)


def _window() -> Column:
    """The ``w`` tokens that begin at ``pos``, as one string: compiled code, and nothing of the text
    besides is copied for a place."""
    return F.array_join(F.slice("tokens", F.col("pos") + 1, F.col("w")), " ")


def _window_seen(window: Column) -> Column:
    """``window`` of tokens of ``_cut`` as the column ``view`` has it; as ``_seen`` of each token."""
    view = F.col("view")
    inner = F.translate(F.regexp_replace(window, f"{_INNER}[^ ]+", _NAME), _CAPITAL_UNIT + _CAPITAL, _NAME)
    names = F.translate(F.regexp_replace(window, f"[{_INNER}{_CAPITAL}][^ ]+", _NAME), _CAPITAL_UNIT, _NAME)
    plain = F.translate(window, _CAPITAL_UNIT + _INNER + _CAPITAL, _UNIT)
    return F.when(view == INNER, inner).when(view == CAPITALS, names).otherwise(plain)


def _hash(window: Column) -> Column:
    return F.xxhash64("view", "w", window).alias("hash")


def _width(tokens: str = "tokens") -> Column:
    """Tokens a window of an item has."""
    n = F.size(tokens)
    short = F.when(n < SHORT, SHORT_WINDOW).otherwise(WINDOW)
    return F.when(n <= WINDOW, n).otherwise(short)


def _is_slot(t: Column) -> Column:
    return t.isin(_NUMBER, _NAME, _UNIT)


def leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    coverage: float = COVERAGE,
    consistency: float = CONSISTENCY,
    run: int = RUN,
    any_case: bool = False,
) -> DataFrame:
    """(doc_id, text_key, item_id, n_windows, matched, coverage, slots, consistency) of each leak.

    A document leaks an item if it holds at least ``coverage`` of the item's distinct template
    windows, or of its tokens along one alignment, or ``run`` tokens along one, and, where these
    have slots, at least ``consistency`` of the slot values follow one replacement per alignment.
    ``coverage`` of a row is the larger of both shares; the first view that finds a leak gives the
    row. ``any_case`` also finds copies that differ in case. Items of up to a window are matched
    whole; of items under ``LEAST_TOKENS`` tokens the slots must hold the same values as well, and
    items under ``LEAST_INSIDE`` tokens are found only where they are the whole text. Defined cases: a
    null or empty text has no windows, on either side; rows that repeat a doc_id or an item_id are told
    apart by their texts, and fully equal rows give one result; empty tables give no rows; other columns
    are ignored; texts of any length are read whole.
    """
    views = [INNER, CAPITALS, *[PLAIN] * any_case]
    items = benchmark.select("text", F.xxhash64("item_id", "text").alias("item_key")).distinct()
    items = items.select("*", _cut(F.col("text")).alias("tokens")).where(F.size("tokens") > 0)
    items = items.withColumn("view", F.explode(F.array(*map(F.lit, views))))
    items = items.withColumn("tokens", F.transform("tokens", lambda t: _seen(t, F.col("view")))).withColumn("w", _width())
    items = written(items, "decontaminate-items")
    windows = items.select("*", F.explode(F.sequence(F.lit(0), F.size("tokens") - F.col("w"))).alias("pos"))
    # In this view a window of slots nearly alone says nothing: titles and shouting are all capitals.
    slots = F.size(F.filter(F.slice("tokens", F.col("pos") + 1, F.col("w")), _is_slot))
    windows = windows.where((F.col("view") != CAPITALS) | (2 * slots <= F.col("w")))
    begin = _begin(_three()).alias("begin")
    windows = windows.select(
        "item_key", "view", "w", F.size("tokens").alias("n_tokens"), F.col("pos").alias("item_pos"), begin,
        _hash(_window()),
    )
    windows = written(windows, "decontaminate-windows")
    small = F.broadcast if windows.count() <= BROADCAST_WINDOWS else lambda df: df
    begins = small(windows.select("begin", "view", "w").distinct()).alias("b")
    needles = small(windows.select("hash").distinct())
    # Only where a window of an item can begin is a window built and hashed.
    meet = (F.col("p.begin") == F.col("b.begin")) & ((F.col("of") == ALL) | (F.col("of") == F.col("view")))
    fits = F.col("pos") + F.col("w") <= F.size("tokens")
    alone = (F.col("w") >= LEAST_INSIDE) | (F.size("tokens") == F.col("w"))
    found = _places(docs, views).alias("p").join(begins, meet & fits & alone)
    found = found.select("doc_id", "text_key", "pos", _hash(_window_seen(_window())))
    found = found.join(needles, "hash", "left_semi").select("doc_id", "text_key", "pos", "hash").distinct()
    hits = written(found, "decontaminate-hits").join(small(windows.drop("begin")), "hash")
    totals = windows.groupBy("item_key", "view").agg(F.countDistinct("hash").alias("n_windows"))
    pair = ["doc_id", "text_key", "item_key", "view"]
    matched = hits.groupBy(*pair).agg(F.countDistinct("hash").alias("matched"))
    # Along one alignment a window covers its tokens up to the next window's first.
    at = F.array_sort(F.collect_set("item_pos"))
    shift = (F.col("pos") - F.col("item_pos")).alias("shift")
    runs = hits.groupBy(*pair, "w", "n_tokens", shift).agg(at.alias("at"))
    gaps = F.zip_with(
        F.slice("at", 2, F.size("at")), F.slice("at", 1, F.size("at") - 1), lambda b, a: F.least(b - a, F.col("w"))
    )
    aligned = (
        runs.withColumn("tokens", F.col("w") + F.aggregate(gaps, F.lit(0), lambda x, y: x + y))
        .groupBy(*pair, "w", "n_tokens")
        .agg(F.max("tokens").alias("run"))
    )
    share = F.greatest(F.col("matched") / F.col("n_windows"), F.col("run") / F.col("n_tokens"))
    short = (F.col("n_tokens") < SHORT) & (F.col("n_tokens") > WINDOW)
    least = F.when(short, min(1.0, coverage + SHORT_MORE)).otherwise(coverage)
    covered = (
        matched.alias("m")
        .join(aligned.alias("a"), _same("m", "a"))
        .select("m.*", "n_tokens", "run")
        .join(totals, ["item_key", "view"])
        .withColumn("coverage", share)
        .where((F.col("coverage") >= least) | (F.col("run") >= run))
        .drop("run")
    )
    covered = written(covered, "decontaminate-covered")
    checked = _consistency(docs, items, hits, covered)
    judged = covered.alias("c").join(checked.alias("s"), _same("c", "s"), "left").select(
        "c.*",
        F.coalesce("slots", F.lit(0)).cast("bigint").alias("slots"),
        F.coalesce("kept", F.lit(0)).cast("bigint").alias("kept"),
        F.coalesce("consistency", F.lit(1.0)).alias("consistency"),
    )
    equal = (F.col("n_tokens") >= LEAST_TOKENS) | (F.col("kept") == F.col("slots"))
    judged = judged.where((F.col("consistency") >= consistency) & equal)
    values = ["n_windows", "matched", "coverage", "slots", "consistency"]
    first = F.min(F.struct("view", *values)).alias("first")
    names = benchmark.select(F.xxhash64("item_id", "text").alias("item_key"), "item_id").distinct()
    return judged.groupBy("doc_id", "text_key", "item_key").agg(first).join(names, "item_key").select(
        "doc_id", "text_key", "item_id", *[F.col(f"first.{v}").alias(v) for v in values]
    )


def _same(a: str, b: str) -> Column:
    equal = [F.col(f"{a}.{k}") == F.col(f"{b}.{k}") for k in ("text_key", "item_key", "view")]
    return reduce(lambda x, y: x & y, equal, F.col(f"{a}.doc_id").eqNullSafe(F.col(f"{b}.doc_id")))


def _consistency(
    docs: DataFrame, items: DataFrame, hits: DataFrame, covered: DataFrame
) -> DataFrame:
    """Share of slot values that follow the commonest replacement, per document and item."""
    keys = ["doc_id", "text_key", "item_key", "view"]
    window = F.slice("i.tokens", F.col("item_pos") + 1, _width("i.tokens"))
    kept = hits.alias("h").join(covered.select(*keys).alias("c"), _same("h", "c"), "left_semi")
    slotted = (
        kept.alias("h")
        .join(items.drop("w").alias("i"), ["item_key", "view"])
        .where(F.exists(window, _is_slot))
        .select("h.doc_id", "h.text_key", "item_key", "view", "pos", "item_pos", "i.tokens", "i.text")
    )
    same = F.col("d.doc_id").eqNullSafe(F.col("s.doc_id")) & (
        F.xxhash64("d.text") == F.col("s.text_key")
    )
    index = F.explode(F.sequence(F.lit(0), _width() - 1))
    # Only positions leave the join; values are read from the two texts at those positions.
    spots = (
        slotted.withColumn("k", index)
        .withColumn("type", F.get("tokens", F.col("item_pos") + F.col("k")))
        .where(_is_slot(F.col("type")))
        .select(
            *keys,
            (F.col("pos") + F.col("k")).alias("at"),
            (F.col("pos") - F.col("item_pos")).alias("shift"),
            F.get(tokens(F.col("text")), F.col("item_pos") + F.col("k")).alias("old"),
        )
        .distinct()
    )
    values = (
        docs.select("doc_id", "text")
        .alias("d")
        .join(broadcast_if_few(written(spots, "decontaminate-slots")).alias("s"), same)
        .select(
            *[f"s.{k}" for k in keys],
            "shift",
            F.lower("old").alias("old"),
            F.lower(F.get(tokens(F.col("d.text")), F.col("at"))).alias("new"),
        )
    )
    pairs = values.groupBy(*keys, "shift", "old", "new").agg(F.count("*").alias("n"))
    same = F.sum(F.when(F.col("old") == F.col("new"), F.col("n")).otherwise(0)).alias("kept")
    olds = pairs.groupBy(*keys, "shift", "old").agg(F.max("n").alias("most"), F.sum("n").alias("n"), same)
    return olds.groupBy(*keys).agg(
        F.sum("n").alias("slots"), F.sum("kept").alias("kept"), (F.sum("most") / F.sum("n")).alias("consistency")
    )


def without_leaks(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``docs`` without the documents that leak an item, all columns as they were."""
    bad = leaks(docs, benchmark, **options).select("doc_id", "text_key").distinct()
    bad = broadcast_if_few(written(bad, "decontaminate-bad"))
    same = F.col("d.doc_id").eqNullSafe(F.col("b.doc_id")) & (
        F.xxhash64("d.text") == F.col("b.text_key")
    )
    return docs.alias("d").join(bad.alias("b"), same, "left_anti").select(*docs.columns)
