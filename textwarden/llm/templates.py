"""Benchmark decontamination by templates, in DataFrame functions only.

Texts are cut into tokens (runs of letters and digits; a number with its separators and
decimals is one).  A token is canonicalised: numbers
become one placeholder, units behind a number another, and names a third; all others are
lower-cased.  What is a name has two readings, since a sentence may begin with one: capitalised
words inside a sentence, or all capitalised words.  Texts are compared in both, each by itself,
and the reading that matches better counts.  Windows of ``WINDOW`` template tokens of the documents
are joined by hash with those of the benchmark.  A document that holds at least ``SHARE`` of
an item's windows, with slots filled consistently (one value of the item never stands for two)
is contaminated by the item: exact copies, and copies with other numbers, names or units.
Windows are counted, and slots compared, within one place at a time: an aligned run (document
position minus item position), the runs within about an item's length of one another (copies
with words put in or left out), and the whole document (parts far apart).  The place with most
windows counts.  An item shorter than a window is one window of all its tokens.

A window that has nothing but placeholders says nothing and is not used.  Defined cases: null
texts are empty; empty texts and items match nothing; null ids take part as ids of their own
only in benchmark items, documents without id are never reported but kept; repeated windows
count once; repeated rows give equal results; texts are read whole; other columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import table

WINDOW = 5
SHARE = 0.8
# A benchmark of more windows than this is joined by shuffle rather than by broadcast.
BROADCAST_WINDOWS = 200_000

# Units that are slots when they follow a number.
UNITS = """
mm cm m km inch inches feet ft yard yards mile miles mg g kg t ton tons ounce ounces lb lbs
pound pounds ml l liter liters litre litres gallon gallons s sec second seconds min minute
minutes h hour hours day days week weeks month months year years dollar dollars usd euro euros
eur cent cents percent degree degrees kmh mph watt watts volt volts
""".split()
# Placeholders inside templates: a number, a unit, a name.
NUM, UNIT, NAME = "\u0003", "\u0002", "\u0001"
# Marks a capitalised word that begins a sentence: a name in the second reading only.
START = "\u0004"
# The readings as bits: a window may have the same template in both.
INSIDE, ANYWHERE = 1, 2
PLACEHOLDERS = (NUM, UNIT, NAME)
_WORD = r"[\p{L}\p{N}]+"
_NUMBER = r"(?<![\p{L}\p{N}])[0-9]+(?:[.,'’][0-9]+)*(?![\p{L}\p{N}])"


def marked(text: Column) -> Column:
    """Text with a mark before each name, unit and capitalised start of a sentence; control
    marks of its own are dropped."""
    units = "|".join(sorted(UNITS, key=len, reverse=True))
    out = F.translate(F.coalesce(text, F.lit("")), "".join((*PLACEHOLDERS, START)), "    ")
    # Inside a sentence: only blanks or a comma since the last token.
    out = F.regexp_replace(out, r"([\p{L}\p{N}],?[ \t]{1,3})(\p{Lu}\p{Ll})", f"$1{NAME}$2")
    out = F.regexp_replace(out, rf"(?<![\p{{L}}\p{{N}}{NAME}])(\p{{Lu}}\p{{Ll}})", f"{START}$1")
    return F.regexp_replace(out, rf"([0-9][ \t]?){NAME}?((?i:{units})\b)", f"$1 {UNIT}$2")


def raw_tokens(text: Column) -> Column:
    """Tokens of a marked text, in lower case and without marks."""
    return F.regexp_extract_all(F.lower(text), F.lit(f"{_NUMBER}|{_WORD}"), F.lit(0))


def template_tokens(text: Column) -> Column:
    """Tokens of a marked text, slots as placeholders and starts of sentences still marked, with
    blanks between: as many as ``raw_tokens`` has."""
    out = F.regexp_replace(text, f"([{NAME}{UNIT}]){_WORD}", "$1")
    out = F.regexp_replace(out, _NUMBER, NUM)
    return F.array_join(F.regexp_extract_all(
        F.lower(out), F.lit(f"[{NAME}{UNIT}{NUM}]|{START}?{_WORD}"), F.lit(0)), " ")


def windows(df: DataFrame, key: str, text: str, size: int = WINDOW) -> DataFrame:
    """(id, at, n, raw, reads, h, form) of each window: its position, the text's number of
    tokens, its own tokens, the readings that give a template, the template's hash and tokens.

    Built from shifted copies of the token arrays side by side, so that generating, hashing
    and joining run compiled.
    """
    def padded(array: Column) -> Column:
        # A short text is one window, filled up with empty tokens.
        return F.when(F.size(array) < size, F.concat(
            array, F.array_repeat(F.lit(""), size - F.size(array)))).otherwise(array)

    rows = df.select(F.col(key).alias("id"), marked(F.col(text)).alias("m"))
    rows = rows.select("id", template_tokens(F.col("m")).alias("t"), raw_tokens(F.col("m")).alias("r"))
    rows = rows.select(
        "id", padded(F.split(F.translate("t", START, ""), " ")).alias("t"),
        padded(F.split(F.regexp_replace("t", f"{START}[^ ]+", NAME), " ")).alias("s"),
        padded(F.col("r")).alias("r"))
    kinds = ("t", "s", "r")
    shifted = [F.slice(c, i + 1, F.size(c) - (size - 1)).alias(f"{c}{i}")
               for c in kinds for i in range(size)]
    places = F.sequence(F.lit(0), F.size("t") - size).alias("at")
    wide = rows.select("id", F.size("t").alias("n"), places, *shifted).select(
        "id", "n", F.inline(F.arrays_zip("at", *[f"{c}{i}" for c in kinds for i in range(size)])))
    inside, anywhere, raws = ([f"{c}{i}" for i in range(size)] for c in kinds)
    wide = wide.select(
        "id", "at", "n", *inside, *anywhere, *raws, F.xxhash64(*inside).alias("h1"),
        F.xxhash64(*anywhere).alias("h2"))

    def told(form: list[str]) -> Column:
        return reduce(Column.__or__, [~F.col(f).isin("", *PLACEHOLDERS) for f in form])

    same = F.col("h1") == F.col("h2")
    forms = F.array(
        F.when(told(inside), F.struct(
            F.when(same, INSIDE | ANYWHERE).otherwise(INSIDE).alias("reads"),
            F.col("h1").alias("h"), F.array(*inside).alias("form"))),
        F.when(~same & told(anywhere), F.struct(
            F.lit(ANYWHERE).alias("reads"), F.col("h2").alias("h"),
            F.array(*anywhere).alias("form"))))
    return wide.select(
        "id", "at", "n", F.array(*raws).alias("raw"), F.explode(forms).alias("f")).where(
        "f is not null").select("id", "at", "n", "raw", "f.reads", "f.h", "f.form")


def _slots(form: Column, raw: Column) -> Column:
    """The window's own tokens where its template has placeholders, null elsewhere."""
    return F.zip_with(form, raw, lambda f, r: F.when(f.isin(*PLACEHOLDERS), r))


def _readings(bits: Column) -> Column:
    return F.filter(F.array(F.lit(INSIDE), F.lit(ANYWHERE)), lambda r: bits.bitwiseAND(r) > 0)


def contaminated(docs: DataFrame, items: DataFrame, *, key: str = "doc_id", text: str = "text",
                 item_key: str = "item_id", item_text: str = "text", share: float = SHARE,
                 ) -> DataFrame:
    """Pairs (doc, item) with windows matched, all of the item's, and whether slots changed."""
    own = windows(items, item_key, item_text).select(
        F.col("id").alias("item"), "h", F.col("at").alias("item_at"), F.col("n").alias("own_n"),
        F.col("reads").alias("own_reads"),
        _slots(F.col("form"), F.col("raw")).alias("item_slots")).distinct()
    sizes = own.select("item", "h", F.explode(_readings(F.col("own_reads"))).alias("reading")).groupBy(
        "item", "reading").agg(F.countDistinct("h").alias("n_windows"))
    # Checked size: a benchmark is small, but nothing here relies on it.
    if own.count() <= BROADCAST_WINDOWS:
        own, sizes = F.broadcast(own), F.broadcast(sizes)
    shift = F.col("at") - F.col("item_at")
    # Two copies are at least an item's length apart, so a stretch of that length holds one;
    # stretches overlap by half, so a copy that drifts by less than that is whole in one.
    places = F.array(*[F.struct(F.lit(kind).alias("kind"), where.cast("long").alias("where"))
                       for kind, where in enumerate((
                           shift, F.floor(shift / F.col("own_n")),
                           F.floor(shift / F.col("own_n") + 0.5), F.lit(0)))])
    # A window counts in the readings that give both texts its template.
    hits = windows(docs.where(F.col(key).isNotNull()), key, text).drop("n").join(own, "h").select(
        "id", "item", "h", "item_slots", _slots(F.col("form"), F.col("raw")).alias("doc_slots"),
        places.alias("places"),
        F.explode(_readings(F.col("reads").bitwiseAND(F.col("own_reads")))).alias("reading"),
    ).withColumn("place", F.explode("places")).drop("places").distinct()
    place = ["id", "item", "reading", "place"]
    # A value of the item that stands for two values in one place leaves out its windows there.
    pairs = hits.select(
        *place, "h", F.explode_outer(F.filter(
            F.arrays_zip("item_slots", "doc_slots"),
            lambda z: z["item_slots"].isNotNull())).alias("slot"))
    values = pairs.where("slot is not null").groupBy(*place, "slot.item_slots").agg(
        F.min("slot.doc_slots").alias("low"), F.max("slot.doc_slots").alias("high"))
    uneven = pairs.join(
        values.where("low <> high").select(*place, F.col("item_slots").alias("value")),
        place).where("slot.item_slots = value").select(*place, "h").distinct()
    even = hits.join(uneven, [*place, "h"], "left_anti")
    found = even.groupBy(*place).agg(
        F.countDistinct("h").alias("n_matched"),
        F.coalesce(F.max((F.col("item_slots") != F.col("doc_slots")).cast("int")), F.lit(0))
        .alias("changed"))
    best = found.join(sizes, ["item", "reading"]).where(
        F.col("n_matched") >= share * F.col("n_windows")).groupBy("id", "item").agg(F.max(F.struct(
            (F.col("n_matched") / F.col("n_windows")).alias("share"),
            (1 - F.col("changed")).alias("same"), (-F.col("reading")).alias("first"),
            "n_matched", "n_windows")).alias("best"))
    return best.select(
        F.col("id").alias("doc_id"), F.col("item").alias("item_id"), "best.n_matched",
        "best.n_windows", (F.col("best.same") == 0).alias("reparameterised"))


def decontaminate(docs: DataFrame, items: DataFrame, key: str = "doc_id",
                  text: str = "text", **options) -> DataFrame:
    """``docs`` without the documents that hold a benchmark item."""
    found = contaminated(docs, items, key=key, text=text, **options)
    gone = found.select(F.col("doc_id").alias("__gone")).distinct()
    return docs.join(gone, F.col(key) == F.col("__gone"), "left_anti")


def op2_decontamination(spark, folder: str) -> DataFrame:
    """Documents that hold benchmark items, with the items."""
    return contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
