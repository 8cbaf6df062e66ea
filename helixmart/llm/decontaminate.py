"""Benchmark decontamination by template windows, in DataFrame functions only."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from helixmart.llm.common import settle

# Words in a template window, and what an alignment must cover to count as contamination.
WINDOW = 8
LEAST_LITERAL = 4
COVERAGE = 0.5
LEAST_WINDOWS = 6
# Items of fewer words than this, and windows with fewer than LEAST_LITERAL literal words, are matched word for word only.
LEAST_WORDS = 5
# Benchmark windows that may be broadcast (about 0.3 kB each); beyond it both sides are shuffled.
BROADCAST_WINDOWS = 200_000

# Placeholders, what stands for a blank inside a slot, and the words taken for units.
NUMBER, NAME = "⟨n⟩", "⟨p⟩"
JOINT = "\ue000"
UNITS = (
    "mm cm m km in inch inches ft foot feet yd yard yards mile miles mg g kg t lb lbs pound pounds oz ounce ounces ml l "
    "liter liters litre litres gallon gallons s sec second seconds min minute minutes h hr hour hours day days week weeks "
    "month months year years percent degrees dollar dollars cent cents euro euros usd eur gb mb kb tb hz khz mhz ghz w kw "
    "mph kmh meter meters metre metres kilometer kilometers kilometre kilometres gram grams kilogram kilograms"
).split()


# Scripts written without blanks, whose characters are words of their own. A script is looked up by binary
# search, seven times a character; all of these start behind U+0E00, so a comparison spares other characters the searches.
SCRIPTS = "".join(rf"\p{{Is{s}}}" for s in "Han Hiragana Katakana Thai Lao Khmer Myanmar".split())
UNSPACED = rf"\x{{E00}}-\x{{10FFFF}}&&[{SCRIPTS}]"


def spaced(text: Column) -> Column:
    """The words of a text with single blanks between them; each character of a script without blanks is a word."""
    text = F.coalesce(text, F.lit(""))
    apart = F.when(text.rlike(f"[{UNSPACED}]"), F.regexp_replace(text, f"([{UNSPACED}])", " $1 ")).otherwise(text)
    return F.trim(F.regexp_replace(apart, r"[\s ]+", " "))


def plain(words: Column) -> Column:
    """The ``spaced`` words in lower case without punctuation around them; signs of numbers and lone symbols stay."""
    # A mark is looked for first, so that letters cost one test each. Repeated groups would take a frame of the thread's
    # stack for each change between short and long characters; a class takes none.
    mark = r"(?=[^\p{L}\p{M}\p{N} ])"
    before = r"(?<![^ ])[^\p{L}\p{M}\p{N} ]+(?=[\p{L}\p{M}+−-]|(?<![+−-])\p{N})"
    after = r"(?<=[\p{L}\p{M}\p{N}])[^\p{L}\p{M}\p{N} ]+(?![^ ])"
    return F.regexp_replace(F.lower(words), f"{mark}(?:{before}|{after})", "")


def template(df: DataFrame, words: str) -> DataFrame:
    """Add ``joined``, the ``spaced`` text in column ``words`` with the words of a slot made one, and its canonical form ``template``, word for word.

    Placeholders stand for runs of names and for numbers with their units; the rest is in lower case without punctuation.
    """
    # A name is a word with a capital: at the start of a sentence none can be told from other words.
    name, start, units = r"\p{Lu}[\p{L}\p{M}'’-]*", r"(?=\p{Lu})(?<![\p{L}\p{M}\p{N}'’-])", "|".join(UNITS)
    joined = F.regexp_replace(words, rf"{start}({name}) (?=\p{{Lu}})", f"$1{JOINT}")
    measured = F.regexp_replace("_joined", rf"(\p{{N}}) (?=(?:{units})(?![\p{{L}}\p{{M}}\p{{N}}]))", f"$1{JOINT}")
    # Possessive, since Java would take a frame of the thread's stack for each name: some thousand overflow it and end the executor.
    named = F.regexp_replace("joined", rf"{start}{name}(?:{JOINT}{name})*+", NAME)
    counted = F.regexp_replace("_named", rf"(?<![^ ])[^\p{{L}}⟨ ]*\p{{N}}[^\p{{L}} ]*(?:{units})?[^\p{{L}} ]*(?![^ ])", NUMBER)
    # Texts without a digit skip the number patterns. Columns of their own keep each step from being computed twice.
    digits = F.col(words).rlike(r"\p{N}")
    marked = df.withColumn("_joined", joined).withColumn("joined", F.when(digits, measured).otherwise(F.col("_joined")))
    marked = marked.withColumn("_named", named).withColumn("_marked", F.when(digits, counted).otherwise(F.col("_named")))
    return marked.withColumn("template", F.regexp_replace(F.lower("_marked"), r"[^\p{L}\p{M}\p{N}⟨⟩ ]+", "")).drop("_joined", "_named", "_marked")


def _hashes(words: str) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def _window_hash(hashes: str, place: Column, length: int, verbatim: Column) -> Column:
    """Hash of the ``length`` words from ``place`` (1 is the first), from the words' hashes; equal and template windows never meet."""
    return F.xxhash64(F.lit(length), verbatim, *[F.get(hashes, place + (i - 1)) for i in range(length)])


def _sought(items: DataFrame, length: int, verbatim: bool) -> DataFrame:
    """The windows of ``length`` words of items(item_id, item_id_text, item_windows, canon, words)."""
    places = F.when(F.size("canon") >= length, F.sequence(F.lit(1), F.size("canon") - length + 1)).otherwise(F.array().cast("array<int>"))
    rows = items.select("*", F.size("canon").alias("item_length"), _hashes("canon").alias("hashes"), F.explode(places).alias("item_place"))
    return rows.select(
        _window_hash("hashes", F.col("item_place"), length, F.lit(verbatim)).alias("hash"), "item_id", "item_id_text", "item_windows", "item_length", "item_place",
        F.slice("canon", F.col("item_place"), length).alias("item_form"), F.slice("words", F.col("item_place"), length).alias("item_surface"),
    )


def _windows(docs: DataFrame, id_col: str, text_col: str, lengths: list[int]) -> DataFrame:
    """All windows of the documents, of template words and of equal words (``verbatim``): each text is read and cut once.

    Without a length of its own a window's words would be carried whole: they are cut out of the text's lists where they are used.
    """
    words = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(F.col(text_col)).alias("doc_id_text"), spaced(F.col(text_col)).alias("w"))
    read = template(words.withColumn("plain", plain(F.col("w"))), "w")
    read = read.select("doc_id", "doc_id_text", F.split("joined", " ").alias("words"), F.split("template", " ").alias("canon"), F.split("plain", " ").alias("same"))
    read = read.select("*", F.concat(_hashes("canon"), _hashes("same")).alias("hashes"))
    first = F.size("canon")
    rows = read.select("*", F.explode(F.sequence(F.lit(1), F.size("hashes"))).alias("p")).withColumn("verbatim", F.col("p") > first)
    # Filters on the place stay above the lists of words, which are therefore made once.
    left = F.when(F.col("verbatim"), F.size("hashes")).otherwise(first) - F.col("p") + 1
    rows = rows.where(left >= min(lengths))
    made = [F.struct(F.lit(n).alias("length"), _window_hash("hashes", F.col("p"), n, F.col("verbatim")).alias("hash")) for n in lengths]
    if len(made) == 1:
        rows = rows.withColumns({"length": F.lit(lengths[0]), "hash": made[0]["hash"]})
    else:
        fitting = F.explode(F.array(*[F.when(left >= n, m) for n, m in zip(lengths, made, strict=True)]))
        rows = rows.withColumn("window", fitting).where("window is not null").withColumns({"length": F.col("window.length"), "hash": F.col("window.hash")})
    place = F.when(F.col("verbatim"), F.col("p") - first).otherwise(F.col("p"))
    cut = lambda form: F.when(F.col("verbatim"), F.slice("same", place, F.col("length"))).otherwise(F.slice(form, place, F.col("length")))
    return rows.select("doc_id", "doc_id_text", "verbatim", "length", "hash", place.alias("place"), cut("canon").alias("form"), cut("words").alias("surface"))


def _read(df: DataFrame, id_col: str, text_col: str, name: str) -> DataFrame:
    words = spaced(F.col(text_col))
    split = df.select(F.col(id_col).alias(name), F.xxhash64(F.col(text_col)).alias(f"{name}_text"), words.alias("w"))
    return template(split, "w").select(name, f"{name}_text", F.split("joined", " ").alias("words"), F.split("template", " ").alias("canon"))


def _literal(form: Column) -> Column:
    return F.size(F.filter(form, lambda w: ~w.startswith("⟨") & (w != "")))


def _read_plain(df: DataFrame, id_col: str, text_col: str, name: str) -> DataFrame:
    words = F.split(plain(spaced(F.col(text_col))), " ").alias("words")
    read = df.select(F.col(id_col).alias(name), F.xxhash64(F.col(text_col)).alias(f"{name}_text"), words)
    return read.select("*", F.col("words").alias("canon"))


def _begun(benchmark: DataFrame, item_col: str, text_col: str) -> DataFrame:
    """Items, and each that begins with a capital also with a small letter, as it stands inside a sentence."""
    items, first = benchmark.select(item_col, text_col), r"(?s)^(\P{L}*\p{Lu})"
    small = F.concat(F.lower(F.regexp_extract(text_col, first, 1)), F.regexp_replace(text_col, first, ""))
    return items.unionByName(items.where(F.col(text_col).rlike(first)).withColumn(text_col, small))


def _bare(word: Column) -> Column:
    return F.regexp_replace(F.lower(word), rf"^[^\p{{L}}\p{{N}}]+|[^\p{{L}}\p{{N}}]+$|{JOINT}", "")


def _keyed(found: DataFrame) -> DataFrame:
    """Add ``key``, one for each alignment a match belongs to: its word shift, and two bands of neighbouring shifts."""
    band = lambda kind, at: F.struct(F.lit(kind).alias("kind"), at.cast("long").alias("at"))
    shift = F.col("shift")
    bands = F.array(band(0, shift), band(1, F.floor(shift / WINDOW)), band(2, F.floor((shift + WINDOW // 2) / WINDOW)))
    # NULL ids take part: the keys are grouped as one struct.
    return found.withColumn("band", F.explode(bands)).withColumn("key", F.struct("doc_id", "doc_id_text", "item_id", "item_id_text", "band"))


def _hinted(sought: DataFrame) -> DataFrame:
    return F.broadcast(sought) if sought.limit(BROADCAST_WINDOWS + 1).count() <= BROADCAST_WINDOWS else sought


def _lengths(items: DataFrame) -> list[int]:
    """Window lengths: WINDOW, and the whole length of each shorter item."""
    return sorted(r["n"] for r in items.select(F.least(F.size("canon"), F.lit(WINDOW)).alias("n")).distinct().collect())


def _equal_words(benchmark: DataFrame, item_col: str, item_text_col: str) -> tuple[list[int], list[DataFrame]]:
    """Window lengths and windows of the items' words as they are; no word is a slot."""
    items = _read_plain(benchmark, item_col, item_text_col, "item_id").where(F.array_join("words", "") != "")
    items = settle(items.dropDuplicates(["item_id", "item_id_text"]), "decontaminate-words")
    lengths, sought = _lengths(items), []
    for length in lengths:
        pool = items.where(F.size("canon") == length) if length < WINDOW else items.where(F.size("canon") >= WINDOW)
        sought.append(_sought(pool.select("*", (F.size("canon") - length + 1).alias("item_windows")), length, True))
    return lengths, sought


def _meetable(length: int) -> Column:
    """How many windows of ``length`` words of ``canon`` have enough literal words."""
    places = F.sequence(F.lit(1), F.size("canon") - length + 1)
    return F.size(F.filter(places, lambda at: _literal(F.slice("canon", at, length)) >= LEAST_LITERAL))


def _template_words(benchmark: DataFrame, item_col: str, item_text_col: str) -> tuple[list[int], list[DataFrame]]:
    """Window lengths and windows of the items' templates: one length, and one more for each of 5, 6 and 7 that short items have."""
    items = settle(_read(_begun(benchmark, item_col, item_text_col), item_col, item_text_col, "item_id").dropDuplicates(["item_id", "item_id_text"]), "decontaminate-items")
    lengths, sought = [n for n in _lengths(items) if n >= LEAST_WORDS], []
    for length in lengths:
        pool = items.where(F.size("canon") == length) if length < WINDOW else items.where(F.size("canon") >= WINDOW)
        # Shares are of the windows that can be met.
        rows = _sought(pool.select("*", F.greatest(_meetable(length), F.lit(1)).alias("item_windows")), length, False)
        # A name at the start of a sentence may be any word: where it is the same word, it is literal.
        names = F.size(F.filter("item_form", lambda w: w == NAME))
        sought.append(rows.where((_literal(F.col("item_form")) + F.least(names, F.lit(1))) >= LEAST_LITERAL))
    return lengths, sought


def _same(found: DataFrame) -> DataFrame:
    """Alignments of equal windows: key, windows (matched), item_windows, and no slots."""
    # One window is the whole of a short item: once in a document is enough.
    short = F.col("length") < WINDOW
    found = found.withColumn("shift", F.when(short, F.lit(0)).otherwise(F.col("shift")))
    found = found.select("doc_id", "doc_id_text", "item_id", "item_id_text", "item_windows", "item_place", "shift").distinct()
    aligned = _keyed(found).groupBy("key").agg(F.countDistinct("item_place").alias("windows"), F.max("item_windows").alias("item_windows"))
    return aligned.selectExpr("*", "0L as slots", "0L as changed_slots")


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """(doc_id, item_id) of documents that hold a benchmark item, word for word or with other numbers, units or names.

    Both sides become templates; equal template windows of 8 words meet in a hash join. Matches of a document
    and an item on one word shift, or on neighbouring ones, count together. Where a slot value of the item stands for several values in
    the document, windows over its changed places don't count. An alignment counts if its windows cover half of
    the item's, or six windows (13 words), which must be in a row if others conflict. Windows with fewer than four literal words are not template windows. Windows of 8 equal words
    count by themselves, whatever the words are, by the same shares. In scripts without blanks characters are words.

    Edge cases: NULL and empty texts match nothing. Items of 5 to 7 words are matched as a whole; shorter ones
    too, but only word for word. Rows that repeat id and text count as one; rows with one id and several texts are
    tested apart and reported once per item. NULL ids are reported as NULL. Other columns are not looked at.
    Returns also windows (matched), item_windows, slots, changed_slots and kind (verbatim or reparameterised).
    """
    lengths, sought = _template_words(benchmark, item_col, item_text_col)
    more, equal = _equal_words(benchmark, item_col, item_text_col)
    lengths, sought = sorted({*lengths, *more}), [*sought, *equal]
    if not sought:
        empty = docs.select(F.col(id_col).alias("doc_id"), F.lit(None).cast("long").alias("item_id")).limit(0)
        return empty.selectExpr("doc_id", "item_id", "0L as windows", "0L as item_windows", "0L as slots", "0L as changed_slots", "'' as kind")
    sought = settle(reduce(DataFrame.unionByName, sought), "decontaminate-sought")
    met = _windows(docs, id_col, text_col, lengths).join(_hinted(sought), "hash").withColumn("shift", F.col("place") - F.col("item_place"))
    # Equal hashes are confirmed after the write, so that the join needs no slice of a window that meets nothing.
    found = settle(met.drop("hash"), "decontaminate-met").where(F.col("form") == F.col("item_form"))
    aligned = _templates(found.where("not verbatim")).unionByName(_same(found.where("verbatim")))
    enough = (F.col("windows") >= LEAST_WINDOWS) | (F.col("windows") >= COVERAGE * F.col("item_windows"))
    aligned = aligned.where(enough).select(
        F.struct("key.doc_id", "key.item_id").alias("pair"),
        F.struct("windows", (-F.col("changed_slots")).alias("same"), "item_windows", "slots", "changed_slots").alias("best"),
    )
    best = aligned.groupBy("pair").agg(F.max("best").alias("best"))
    return best.select(
        "pair.doc_id", "pair.item_id", "best.windows", F.col("best.item_windows").cast("long").alias("item_windows"), "best.slots", "best.changed_slots",
        F.when(F.col("best.changed_slots") == 0, "verbatim").otherwise("reparameterised").alias("kind"),
    )


def _templates(found: DataFrame) -> DataFrame:
    """Alignments of template windows: key, windows (matched), item_windows, slots, changed_slots."""
    same = F.filter(F.arrays_zip("form", "item_surface", "surface"), lambda z: (z["form"] == NAME) & (_bare(z["item_surface"]) == _bare(z["surface"])))
    found = _keyed(found.where(_literal(F.col("form")) + F.size(same) >= LEAST_LITERAL))
    zipped = F.explode(F.arrays_zip("form", "item_surface", "surface", F.sequence(F.lit(0), F.size("form") - 1).alias("i")))
    slots = found.select("key", "item_place", "item_length", zipped.alias("z")).where(F.col("z.form").startswith("⟨"))
    slots = slots.select(
        "key", "item_length", (F.col("item_place") + F.col("z.i")).alias("at"), F.struct("z.form", _bare(F.col("z.item_surface")).alias("value")).alias("stands"), _bare(F.col("z.surface")).alias("now")
    ).distinct()
    changed = F.col("now") != F.col("stands.value")
    # Names of the text around an item run into its first and last word: these two stand for anything.
    inner = F.when((F.col("at") > 1) & (F.col("at") < F.col("item_length")), F.col("now"))
    values = slots.groupBy("key", "stands").agg(
        F.coalesce(F.min(inner) != F.max(inner), F.lit(False)).alias("mixed"), F.count("*").alias("slots"), F.sum(changed.cast("long")).alias("changed"),
        F.collect_set(F.when(changed & inner.isNotNull(), F.col("at"))).alias("at"),
    )
    # Where a value stands for several, the windows over its changed places conflict.
    conflicts = F.flatten(F.collect_list(F.when(F.col("mixed"), F.col("at")))).alias("conflicts")
    checked = values.groupBy("key").agg(F.sum("slots").alias("slots"), F.sum("changed").alias("changed_slots"), conflicts)
    met = found.select("key", "item_place", "item_windows", F.size("form").alias("length")).distinct()
    met = met.join(checked, "key", "left").withColumn("torn", F.size(F.coalesce("conflicts", F.array().cast("array<int>"))) > 0)
    met = met.where(~F.col("torn") | ~F.exists("conflicts", lambda at: (at >= F.col("item_place")) & (at < F.col("item_place") + F.col("length"))))
    aligned = met.groupBy("key").agg(
        F.count("*").alias("windows"), F.max("item_windows").alias("item_windows"), F.max("slots").alias("slots"), F.max("changed_slots").alias("changed_slots"),
        F.max("torn").alias("torn"), F.array_sort(F.collect_list("item_place")).alias("places"),
    )
    # What is left of a torn alignment must be whole stretches: windows here and there are no passage.
    steps = F.when(F.size("places") >= LEAST_WINDOWS, F.sequence(F.lit(0), F.size("places") - LEAST_WINDOWS)).otherwise(F.array().cast("array<int>"))
    places = F.col("places")
    stretch = F.exists(steps, lambda i: places[i + LEAST_WINDOWS - 1] == places[i] + LEAST_WINDOWS - 1)
    aligned = aligned.where(~F.col("torn") | (F.col("windows") >= COVERAGE * F.col("item_windows")) | stretch)
    return aligned.select("key", "windows", "item_windows", F.coalesce("slots", F.lit(0)).alias("slots"), F.coalesce("changed_slots", F.lit(0)).alias("changed_slots"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows whose id ``contaminated`` reports; every other row stays as it is, rows with NULL ids too."""
    bad = contaminated(docs, benchmark, id_col, text_col).select(F.col("doc_id").alias("_bad")).distinct()
    return docs.join(bad, F.col(id_col) == F.col("_bad"), "left_anti")
