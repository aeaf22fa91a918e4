"""Problem 5: visually identical text with different characters, brought to one form.

Method: text is exploded to positioned code points; a broadcast join brings each code
point's decomposition, combining class, script and look-alike; marks are ordered by class behind
their starter, recomposed by a table of pairs, and the strings rebuilt. Only words that hold a character
which could change are exploded, each distinct word once; all other text is its own
canonical form by construction, so nothing is left out.

The mappings are derived from the Unicode character database that Python carries: a
few thousand rows, fixed, whatever the size of the data.

One form
* canonical composition (NFC);
* invisible characters (format controls, fillers, variation selectors, other controls) are removed;
* blanks other than the space and line breaks become a space;
* width variants of letters and digits become the plain ones;
* a letter foreign to the alphabet of its word becomes the letter of that alphabet that it looks like;
  one that looks like none stays, and its word and row are cases all the same.
The alphabet of a word is the one with a letter that could be of no other word, if it has as many letters
there as Latin has, else Latin; of words without a Latin letter the most frequent one. Letters are compared over all alphabets
that part words by blanks (Latin, Greek, Cyrillic, Armenian, Cherokee, Coptic, Georgian) and the mathematical variants
of their letters. Whole words and lone letters of other scripts stay, as do units such as μm and kΩ and signs such as superscripts,
degree signs and fractions.

Defined results: null text gives null and is no case; empty text is empty; repeated rows are
treated alike; rows with null keys keep them; other columns are ignored; words of any
length are read whole.
"""

from __future__ import annotations

import sys
import unicodedata
from functools import lru_cache
from itertools import chain

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from codexmill.session import cut

# Letters that look like Latin ones, and the Latin letter each looks like.
CYRILLIC_LOOKALIKES = "АВЕЅІЈКМНОРСТУХаеѕіјорсухԁһԛԝкгѵҽӏүԌԚԜѴҮӀ"
CYRILLIC_TARGETS = "ABESIJKMHOPCTYXaesijopcyxdhqwkrvelyGQWVYI"
GREEK_LOOKALIKES = "ΑΒΕΖΗΙΚΜΝΟΡΤΥΧοαγηικνρτυχωϲϳϹͿ"
GREEK_TARGETS = "ABEZHIKMNOPTYXoaynikvptuxwcjCJ"
ARMENIAN_LOOKALIKES = "օսոհցզյՍՕԼՏ"
ARMENIAN_TARGETS = "ounhgqjUOLS"
CHEROKEE_LOOKALIKES = "ᎠᎡᎢᎥᎪᎫᎬᎳᎷᎻᏀᏃᏏᏒᏔᏕᏙᏚᏞᏟᏢᏦᏴ"
CHEROKEE_TARGETS = "DRTiAJEWMHGZbRWSVSLCPKB"
COPTIC_LOOKALIKES = "ⲞⲟⲢⲣⲤⲥⲦⲬⲭⲔⲘⲚⲎ"
COPTIC_TARGETS = "OoPpCcTXxKMNH"
LATIN_LOOKALIKES = "ÐƉɖıɡɑ"
LATIN_TARGETS = "ĐĐđiga"
#: Alphabets that part words by blanks, by the first word of their letters' names; and mathematical letters.
ALPHABETS = {"LATIN": "L", "GREEK": "G", "CYRILLIC": "C", "ARMENIAN": "A", "CHEROKEE": "K", "COPTIC": "P", "GEORGIAN": "E"}
MATHEMATICAL = "M"
# Invisible characters that are not format controls.
FILLERS = "\u034f\u115f\u1160\u17b4\u17b5\u3164\uffa0"
#: Format controls that are visible: prepended number and verse signs.
VISIBLE_FORMATS = frozenset(range(0x600, 0x606)) | {0x6DD, 0x70F, 0x890, 0x891, 0x8E2, 0x110BD, 0x110CD}


def _invisible(cp: int) -> bool:
    c = chr(cp)
    kind = unicodedata.category(c)
    if kind == "Cf":
        return cp not in VISIBLE_FORMATS
    return c in FILLERS or 0xFE00 <= cp <= 0xFE0F or 0xE0100 <= cp <= 0xE01EF or (kind == "Cc" and c not in "\t\n\r\v\f\x85\x1c\x1d\x1e\x1f")


def _blank(cp: int) -> bool:
    c = chr(cp)
    return c in "\t\v\f\x1f" or (unicodedata.category(c) == "Zs" and c != " ")


def _width(cp: int) -> str | None:
    """The plain letter or digit of a width variant."""
    d = unicodedata.decomposition(chr(cp))
    if d.startswith(("<wide>", "<narrow>")) and unicodedata.category(chr(cp))[0] in "LN":
        return "".join(chr(int(x, 16)) for x in d.split()[1:])
    return None


def _script(c: str) -> str:
    """Code of the alphabet (see ``ALPHABETS``), ``M`` a mathematical letter, ``O`` another letter, ``""`` no letter."""
    if not c.isalpha():
        return ""
    if unicodedata.decomposition(c).startswith("<font>"):
        return MATHEMATICAL
    return ALPHABETS.get(unicodedata.name(c, "").split(" ", 1)[0], "O")


#: Ranges whose code points are all themselves: ideographs, Hangul syllables, surrogates, private use, unassigned planes.
THEMSELVES = ((0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xAC00, 0xD7A3), (0xD800, 0xF8FF), (0x20000, 0x2F7FF), (0x30000, 0xDFFFF), (0xE0200, sys.maxunicode))


@lru_cache(maxsize=1)
def mapping_rows() -> list[tuple]:
    """(ch, parts, classes, script, as_latin, as_cyrillic) for every code point that is not simply itself.

    The look-alikes are those of the base letter, so letters with marks have them by their decomposition; those of
    mathematical letters are their compatibility form.
    """
    latin = dict(
        zip(
            CYRILLIC_LOOKALIKES + GREEK_LOOKALIKES + ARMENIAN_LOOKALIKES + CHEROKEE_LOOKALIKES + COPTIC_LOOKALIKES,
            CYRILLIC_TARGETS + GREEK_TARGETS + ARMENIAN_TARGETS + CHEROKEE_TARGETS + COPTIC_TARGETS,
            strict=True,
        )
    )
    always = dict(zip(LATIN_LOOKALIKES, LATIN_TARGETS, strict=True))
    cyrillic = {t: s for s, t in reversed(list(zip(CYRILLIC_LOOKALIKES, CYRILLIC_TARGETS, strict=True)))}
    rows = []
    edges = [0, *(x for a, b in THEMSELVES for x in (a, b + 1)), sys.maxunicode + 1]
    for cp in chain.from_iterable(range(a, b) for a, b in zip(edges[::2], edges[1::2])):
        c = chr(cp)
        kind = unicodedata.category(c)
        if kind in ("Cn", "Co"):
            continue
        if _invisible(cp):
            out = ""
        elif _blank(cp):
            out = " "
        elif (plain := _width(cp)) is not None:
            out = plain
        else:
            out = always.get(c, c)
        out = unicodedata.normalize("NFD", out)
        script = _script(out[:1] or c) if out else ""
        if cp < 128 and not script and out == c:
            continue
        if out == c and not unicodedata.combining(c) and script in ("", "O") and not (script == "O" and cp < 0x3000):
            continue
        base = out[:1]
        as_latin = unicodedata.normalize("NFKC", base) if script == MATHEMATICAL else latin.get(base)
        rows.append((c, list(out), [unicodedata.combining(x) for x in out], script, as_latin, cyrillic.get(base)))
    return rows


#: Blocks in which most code points are their own form: Latin, punctuation, symbols, kana, ideographs.
PLAIN_BLOCKS = ((0x20, 0x7E), (0x1EA0, 0x1EFF), (0xA1, 0x24F), (0x1E00, 0x1E9F), (0x2010, 0x2027), (0x2030, 0x205E), (0x20A0, 0x20BF), (0x2190, 0x23FF), (0x3001, 0x3029), (0x3041, 0x3096), (0x30A1, 0x30FA), (0x4E00, 0x9FFF))


def is_plain(cp: int) -> bool:
    """Whether the code point is its own one form whatever stands around it."""
    c = chr(cp)
    if c in LATIN_LOOKALIKES or _invisible(cp) or _blank(cp) or _width(cp) is not None or _script(c) not in ("", "L", "O"):
        return False
    return unicodedata.category(c) not in ("Mn", "Mc", "Me", "Cn") and unicodedata.is_normalized("NFC", c)


def plain_class() -> str:
    """A Java character class of the plain code points without the space.

    The pattern engine tests the ranges of a class one by one, but leaves a nested class for last: so the
    frequent blocks come first and each further group is nested in the one before.
    """
    groups: list[list[str]] = [[], [], []]
    for n, (first, last) in enumerate(PLAIN_BLOCKS):
        start = None
        for cp in range(first, last + 2):
            if cp <= last and cp != 0x20 and is_plain(cp):
                start = cp if start is None else start
            elif start is not None:
                groups[min(n, 2)].append(f"\\x{{{start:x}}}-\\x{{{cp - 1:x}}}")
                start = None
    return f"[\\r{''.join(groups[0])}[{''.join(groups[1])}[{''.join(groups[2])}]]]"


def all_plain() -> str:
    """A pattern of texts that are their own form by construction."""
    return rf"\A[ \n{plain_class()}]*+\z"


def suspect_word() -> str:
    """A pattern of whole words that hold a code point not known to be plain; each word is read once."""
    return rf"(?<![^ \n]){plain_class()}*+[^ \n]+"


_MAPPING = T.StructType(
    [
        T.StructField("ch", T.StringType()),
        T.StructField("parts", T.ArrayType(T.StringType())),
        T.StructField("classes", T.ArrayType(T.IntegerType())),
        T.StructField("script", T.StringType()),
        T.StructField("as_latin", T.StringType()),
        T.StructField("as_cyrillic", T.StringType()),
    ]
)


def mapping(spark: SparkSession) -> DataFrame:
    """The mapping as a table; its size depends on the Unicode version alone."""
    return spark.createDataFrame(mapping_rows(), _MAPPING)


@lru_cache(maxsize=1)
def composition_pairs() -> dict[tuple[str, str], str]:
    """Pairs of code points and the one that stands for both, without those that stay apart in the composed form."""
    pairs = {}
    for cp in range(0xC0, sys.maxunicode + 1):
        parts = unicodedata.decomposition(chr(cp)).split()
        if len(parts) == 2 and parts[0][0] != "<" and unicodedata.is_normalized("NFC", chr(cp)):
            pairs[chr(int(parts[0], 16)), chr(int(parts[1], 16))] = chr(cp)
    return pairs


def _hangul(a: str, b: str) -> str | None:
    """Syllable of two conjoining letters, which follow a rule instead of a table."""
    x, y = ord(a), ord(b)
    if 0x1100 <= x <= 0x1112 and 0x1161 <= y <= 0x1175:
        return chr(0xAC00 + ((x - 0x1100) * 21 + y - 0x1161) * 28)
    if 0xAC00 <= x <= 0xD7A3 and (x - 0xAC00) % 28 == 0 and 0x11A8 <= y <= 0x11C2:
        return chr(x + y - 0x11A7)
    return None


def compose(points: list[str], classes: list[int]) -> str:
    """Code points in order of their classes behind each starter, with every pair joined that nothing parts."""
    pairs, out, starter, last = composition_pairs(), [], -1, 0
    for c, k in zip(points, classes):
        if starter >= 0 and (starter == len(out) - 1 or last < k):
            joined = pairs.get((out[starter], c)) or (_hangul(out[starter], c) if "\u1161" <= c <= "\u11c2" else None)
            if joined:
                out[starter] = joined
                continue
        if k == 0:
            starter = len(out)
        last = k
        out.append(c)
    return "".join(out)


@F.pandas_udf(T.StringType())
def recompose(points: pd.Series, classes: pd.Series) -> pd.Series:
    return pd.Series([compose(list(p), list(k)) for p, k in zip(points, classes)], dtype=object)


def word_forms(words: DataFrame) -> DataFrame:
    """``word, form, foreign`` for the words (column ``word``, distinct) that differ from their one form or hold a foreign letter.

    Code points carry a digest of their word instead of the word, so a long word does not repeat itself.
    """
    words = words.select("word", F.unhex(F.md5("word")).alias("id"))
    points = words.select("id", F.posexplode(F.regexp_extract_all("word", F.lit(r"(?s)."), F.lit(0))).alias("pos", "ch"))
    points = points.join(F.broadcast(mapping(words.sparkSession)), "ch", "left")
    points = points.withColumns({"script": F.coalesce("script", F.lit("")), "parts": F.coalesce("parts", F.array("ch")), "classes": F.coalesce("classes", F.array(F.lit(0)))})
    script = F.col("script")
    own = W.partitionBy("id")
    hidden = F.size("parts") == 0  # an invisible character does not part a word
    is_mark = F.coalesce(F.get("classes", F.lit(0)) > 0, F.lit(False)) & (script == "")
    points = points.withColumn("run", F.sum(((script == "") & ~hidden & ~is_mark).cast("int")).over(own.orderBy("pos")))
    run = W.partitionBy("id", "run")
    others = [x for x in ALPHABETS.values() if x != "L"]
    counts = {f"n{x}": F.sum((script == x).cast("int")).over(run) for x in ALPHABETS.values()}
    native = {f"t{x}": F.max((script == x) & F.col("as_latin").isNull()).over(run) for x in others}
    letter = script != ""
    ends = {"first": F.min(F.when(letter, F.struct("pos", "ch"))).over(run), "last": F.max(F.when(letter, F.struct("pos", "ch"))).over(run)}
    points = points.withColumns(counts | native | ends)
    most = F.array_max(F.array(*[F.struct(F.col(f"n{x}").alias("n"), F.lit(x).alias("x")) for x in others]))["x"]
    host = F.lit(None).cast("string")
    for x in others:
        host = F.when(F.col(f"t{x}") & (F.col(f"n{x}") >= F.col("nL")), x).otherwise(host)
    points = points.withColumn("host", F.coalesce(host, F.when(F.col("nL") > 0, "L").otherwise(most)))
    unit = (F.col("nG") == 1) & (((F.col("first.ch") == "μ") & F.col("nL").between(1, 2)) | ((F.col("last.ch") == "Ω") & (F.col("nL") <= 1)))
    foreign = F.when(script == MATHEMATICAL, F.col("nL") > 0).otherwise(script.isin(*ALPHABETS.values()) & (script != F.col("host")) & ~unit)
    points = points.withColumn("foreign", foreign)
    rest = F.slice("parts", 2, F.greatest(F.size("parts") - 1, F.lit(0)))
    into_latin = F.col("as_latin").isNotNull() & ((F.col("host") == "L") | (script == MATHEMATICAL))
    into_cyrillic = F.col("as_cyrillic").isNotNull() & (script == "L") & (F.col("host") == "C")
    swapped = F.when(F.col("foreign") & into_latin, F.concat(F.array("as_latin"), rest)).when(F.col("foreign") & into_cyrillic, F.concat(F.array("as_cyrillic"), rest)).otherwise(F.col("parts"))
    points = points.withColumn("out", swapped)
    zipped = F.arrays_zip(F.col("out").alias("out"), F.col("classes").alias("classes"))
    units = points.select("id", "pos", "foreign", F.posexplode_outer(zipped).alias("sub", "unit"))
    units = units.select("id", "pos", "sub", "foreign", F.col("unit.out").alias("ch"), F.coalesce("unit.classes", F.lit(0)).alias("ccc"))
    # Marks are ordered by class behind their starter; equal classes keep their order.
    starter = F.sum((F.col("ch").isNotNull() & (F.col("ccc") == 0)).cast("int")).over(own.orderBy("pos", "sub"))
    unit_row = F.when(F.col("ch").isNotNull(), F.struct("starter", "ccc", "pos", "sub", "ch"))
    ordered = units.withColumn("starter", starter).groupBy("id").agg(F.array_sort(F.collect_list(unit_row)).alias("u"), F.max("foreign").alias("foreign"))
    # A word of nothing but invisible characters has no unit left; its form is empty.
    rebuilt = ordered.select("id", "foreign", recompose(F.transform("u", lambda x: x["ch"]), F.transform("u", lambda x: x["ccc"])).alias("form"))
    return words.join(rebuilt, "id").select("word", "form", "foreign").filter((F.col("form") != F.col("word")) | F.col("foreign"))


def _suspect_words(rows: DataFrame) -> DataFrame:
    """``row_key, word`` for the distinct words of each row that hold a suspect character."""
    return rows.select("row_key", F.explode(F.array_distinct(F.regexp_extract_all("text", F.lit(suspect_word()), F.lit(0)))).alias("word"))


def differing_rows(df: DataFrame, key, text: str) -> DataFrame:
    """``row_key`` of the rows whose text differs from its one form or has a letter foreign to its word; each key once."""
    rows = df.select(key.alias("row_key"), F.col(text).alias("text"))
    words = cut(_suspect_words(rows))  # used twice, and far smaller than the texts
    forms = word_forms(words.select("word").distinct()).select("word")
    return words.join(forms, "word", "left_semi").select("row_key").distinct()


def one_form(df: DataFrame, key, text: str) -> DataFrame:
    """``row_key, text_form, changed`` for every row; ``changed`` also where a foreign letter has no known counterpart and stays."""
    rows = df.select(key.alias("row_key"), F.col(text).alias("text"))
    is_suspect = F.coalesce(~F.col("text").rlike(all_plain()), F.lit(False))
    clean = rows.filter(~is_suspect).select("row_key", F.col("text").alias("text_form"), F.lit(False).alias("changed"))
    suspect = rows.filter(is_suspect)
    words = _suspect_words(suspect).distinct()
    forms = word_forms(words.select("word").distinct())
    maps = words.join(forms, "word").groupBy("row_key").agg(F.map_from_entries(F.collect_list(F.struct("word", "form"))).alias("m")).withColumnRenamed("row_key", "__key")
    fixed_word = lambda w: F.coalesce(F.try_element_at("m", w), w)
    fixed_line = lambda line: F.array_join(F.transform(F.split(line, " ", -1), fixed_word), " ")
    joined = suspect.join(maps, suspect["row_key"].eqNullSafe(maps["__key"]), "left")
    form = F.when(F.col("m").isNull(), F.col("text")).otherwise(F.array_join(F.transform(F.split("text", "\n", -1), fixed_line), "\n"))
    fixed = joined.select("row_key", form.alias("text_form"), F.col("m").isNotNull().alias("changed"))
    return clean.unionByName(fixed)
