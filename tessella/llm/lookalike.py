"""One consistent form for texts that look alike but are written with other characters.

Texts are exploded to positioned code points, a broadcast join replaces each by its look-alike and decomposed
parts, combining marks are put in the order of their classes, recomposed, and the strings are rebuilt.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.session import written

# Letters of other scripts and of phonetic notation shaped like Latin letters.
CYRILLIC = dict(zip("АВЕКМНОРСТУХЅІЈԚԜҮѴӀаеорсухѕіјһԁԛԝѵӏ", "ABEKMHOPCTYXSIJQWYVIaeopcyxsijhdqwvl", strict=True))
GREEK = dict(zip("ΑΒΕΖΗΙΚΜΝΟΡΤΥΧϹͿανορυϲϳ", "ABEZHIKMNOPTYXCJavopucj", strict=True))
ARMENIAN = dict(zip("ՕՍՏԼօսհզցոյ", "OUSLouhqgnj", strict=True))
CHEROKEE = dict(zip("ᎪᏴᏟᎠᎬᏀᎻᎫᏦᏞᎷᏢᏚᎢᏙᎳᏃᎡ", "ABCDEGHJKLMPSTVWZR", strict=True))
LISU = dict(zip("ꓐꓑꓓꓔꓖꓗꓙꓚꓜꓝꓟꓠꓡꓢꓣꓦꓧꓪꓫꓬꓮꓰꓲꓳꓴ", "BPDTGKJCZFMNLSRVHWXYAEIOU", strict=True))
COPTIC = dict(zip("ⲞⲢⲤⲘⲚⲔⲎⲦⲬⲟⲣⲥ", "OPCMNKHTXopc", strict=True))
PHONETIC = dict(zip("ɡɑ", "ga", strict=True))
# Radicals without a decomposition of their own and the characters of the same shape.
RADICALS = dict(zip("⺀⺈⺊⺌⺍⺎⺐⺒⺓⺔⺖⺘⺛⺝⺞⺟⺠⺡⺣⺤⺥⺧⺨⺩⺫⺬⺭⺮⺯⺰⺱⺲⺵⺶⺹⺼⺾⺿⻀⻁⻃⻄⻅⻈⻉⻋⻌⻍⻎⻐⻑⻒⻓⻔⻖⻘⻙⻚⻛⻜⻝⻟⻠⻢⻣⻤⻥⻦⻧⻨⻩⻪⻬⻮⻰⻱⻲", "冫𠂊卜小小兀尢巳幺彑忄扌旡月歺母民氵灬爫爫牛犭王罒示礻竹糹纟罓罒㓁羊耂月艹艹艹虎覀西见讠贝车辶辶辶钅長镸长门阝青韦页风飞食飠饣马骨鬼鱼鸟卤麦黄黾齐齿龙龜亀", strict=True))
LOOKALIKE = {**CYRILLIC, **GREEK, **ARMENIAN, **CHEROKEE, **LISU, **COPTIC, **PHONETIC, **RADICALS}

#: Compatibility decompositions that change width, a kind of blank or the drawing of a letter, not its identity.
_SAME_LOOK = ("<wide>", "<narrow>", "<noBreak>", "<font>")
#: Visible format characters and fillers that leave no mark.
_VISIBLE_FORMAT = {*range(0x600, 0x606), 0x6DD, 0x70F, 0x890, 0x891, 0x8E2, *range(0xFFF9, 0xFFFC), 0x110BD, 0x110CD, *range(0x13430, 0x13440)}
_FILLERS = {0x34F, 0x115F, 0x1160, 0x17B4, 0x17B5, 0x3164, 0xFFA0, *range(0x180B, 0x1810), *range(0xFE00, 0xFE10), *range(0xE0100, 0xE01F0)}
_KEPT_CONTROLS = {0x0A, 0x0D}


def _step(c: str) -> str:
    """One replacement of a character, or the character itself."""
    cp, kind = ord(c), unicodedata.category(c)
    if cp in _FILLERS or (kind == "Cf" and cp not in _VISIBLE_FORMAT):
        return ""
    if kind == "Zs" or cp in (0x09, 0x0B, 0x0C, 0x2800):
        return " "
    if kind == "Cc" and cp not in _KEPT_CONTROLS and cp != 0x85:
        return ""
    if c in LOOKALIKE:
        return LOOKALIKE[c]
    parts = unicodedata.decomposition(c).split()
    if parts and parts[0] in _SAME_LOOK:
        return "".join(chr(int(x, 16)) for x in parts[1:])
    if parts and 0x2E80 <= cp <= 0x2FDF:
        return "".join(chr(int(x, 16)) for x in parts[1:])
    return unicodedata.normalize("NFD", c)


def fold_char(c: str) -> str:
    """All parts a character stands for, decomposed."""
    seen = c
    for _ in range(8):
        after = "".join(map(_step, seen))
        if after == seen:
            break
        seen = after
    return seen


@lru_cache(1)
def fold_rows() -> list[tuple[str, list[tuple[str, int]]]]:
    """(character, [(part, combining class)]) for every character that isn't simply a starter standing for itself."""
    rows = []
    for cp in range(0x110000):
        if 0xD800 <= cp < 0xE000:
            continue
        c = chr(cp)
        if cp < 0x7F and cp >= 0x20:
            continue
        if not (unicodedata.decomposition(c) or unicodedata.combining(c) or c in LOOKALIKE or cp in _FILLERS or 0xAC00 <= cp <= 0xD7A3 or unicodedata.category(c) in ("Cf", "Cc", "Zs") or cp == 0x2800):
            continue
        parts = [(x, unicodedata.combining(x)) for x in fold_char(c)]
        if parts != [(c, 0)]:
            rows.append((c, parts))
    return rows


@lru_cache(1)
def compositions() -> dict[str, str]:
    """Pair -> composed character, by the canonical rule; Hangul goes by arithmetic instead."""
    out = {}
    for cp in range(0xC0, 0x30000):
        parts = unicodedata.decomposition(chr(cp)).split()
        if len(parts) == 2 and parts[0][0] != "<":
            pair = "".join(chr(int(x, 16)) for x in parts)
            if unicodedata.normalize("NFC", pair) == chr(cp):
                out[pair] = chr(cp)
    return out


@lru_cache(1)
def attaching() -> list[str]:
    """Characters without combining class that may compose with the one before: Hangul vowels and finals, vowel signs."""
    return [*map(chr, (*range(0x1161, 0x1176), *range(0x11A8, 0x11C3))), *sorted({p[1] for p in compositions() if not unicodedata.combining(p[1])})]


def fold_table(spark: SparkSession) -> DataFrame:
    """The mappings as a table; its size is that of the Unicode tables, some twenty thousand rows."""
    return spark.createDataFrame(fold_rows(), "ch string, parts array<struct<part:string,ccc:int>>")


#: Before each base, in place of a base that a text lacks, and before one that may compose with the base before; folding
#: takes all three out of texts.
_BASE, _NONE, _JOIN = "\x01", "\x02", "\x03"


def _char(code: Column) -> Column:
    return F.decode(F.unhex(F.lpad(F.hex(code), 4, "0")), "UTF-16BE")


def _composed(base: Column, after: Column) -> Column:
    """The character composed of two, or null."""
    pairs = F.create_map(*[F.lit(x) for kv in sorted(compositions().items()) for x in kv])
    a, b = F.ascii(base), F.ascii(after)
    syllable = F.when(a.between(0x1100, 0x1112) & b.between(0x1161, 0x1175), _char(0xAC00 + ((a - 0x1100) * 21 + (b - 0x1161)) * 28)).when(
        a.between(0xAC00, 0xD7A3) & ((a - 0xAC00) % 28 == 0) & b.between(0x11A8, 0x11C2), _char(a + b - 0x11A7)
    )
    return F.coalesce(syllable, F.try_element_at(pairs, F.concat(base, after)))


def _recomposed(cluster: Column) -> Column:
    """A base and its marks, each mark behind three digits of its class, in the order of classes and composed; likewise
    for each base after it that may compose with it."""

    def add(acc: Column, m: Column) -> Column:
        mark, ccc = F.substring(m, 11, 1), F.substring(m, 1, 3)
        made = F.when(acc["last"] < ccc, _composed(acc["base"], mark))
        return F.when(made.isNotNull(), F.struct(made.alias("base"), acc["rest"].alias("rest"), acc["last"].alias("last"))).otherwise(
            F.struct(acc["base"].alias("base"), F.concat(acc["rest"], mark).alias("rest"), ccc.alias("last"))
        )

    def join(acc: Column, part: Column) -> Column:
        own = F.substring(part, 1, 1)
        made = F.when(acc["rest"] == "", _composed(acc["base"], own))
        done = F.when(made.isNotNull(), acc["done"]).otherwise(F.concat(acc["done"], acc["base"], acc["rest"]))
        marks = F.regexp_extract_all(part, F.lit(r"(?s)(?<=.)(\d{3}.)"), F.lit(1))
        ranked = F.sort_array(F.transform(marks, lambda m, i: F.concat(F.substring(m, 1, 3), F.lpad(i.cast("string"), 7, "0"), F.substring(m, 4, 1))))
        start = F.struct(F.coalesce(made, own).alias("base"), F.lit("").alias("rest"), F.lit("000").alias("last"))
        return F.aggregate(ranked, start, add, lambda x: F.struct(done.alias("done"), x["base"].alias("base"), x["rest"].alias("rest")))

    none = F.struct(F.lit("").alias("done"), F.lit("").alias("base"), F.lit("").alias("rest"))
    return F.aggregate(F.split(cluster, _JOIN), none, join, lambda x: F.concat(x["done"], x["base"], x["rest"]))


def _rebuilt(parts: Column) -> Column:
    """The string of [(part, ccc)], marks in canonical order and recomposed where there are any.

    Bases and their marks are strung together and parted again, so that a text's length counts once, not squared.
    """
    joins = lambda p: p["part"].isin(attaching())
    marked = F.transform(
        parts,
        lambda p, i: F.when((p["ccc"] == 0) & ((i == 0) | ~joins(p)), F.concat(F.lit(_BASE), p["part"]))
        .when(p["ccc"] == 0, F.concat(F.lit(_JOIN), p["part"]))
        .otherwise(F.concat(F.when(i == 0, _BASE + _NONE).otherwise(""), F.lpad(p["ccc"].cast("string"), 3, "0"), p["part"])),
    )
    clusters = F.split(F.array_join(marked, ""), _BASE)
    joined = F.array_join(F.transform(clusters, lambda c: F.when(F.length(c) <= 1, c).otherwise(_recomposed(c))), "")
    plain = F.array_join(F.transform(parts, lambda p: p["part"]), "")
    return F.when(F.exists(parts, lambda p: (p["ccc"] > 0) | joins(p)), F.replace(joined, F.lit(_NONE), F.lit(""))).otherwise(plain)


def text_id(text: Column) -> Column:
    """A 128-bit name of a text."""
    return F.unhex(F.md5(text.cast("binary")))


def forms(texts: DataFrame) -> DataFrame:
    """``texts`` with its ``form``; it has distinct non-null ``text`` with their ``tid`` = ``text_id``, and maybe more.

    Every distinct text is treated once, however many rows hold it. Code points are spread over the partitions of
    their text's id, and the strings are rebuilt there without another shuffle. The empty text has the empty form.
    ``texts`` is read twice: write it first.
    """
    spark = texts.sparkSession
    points = texts.select("tid", "text").repartition("tid").select("tid", F.posexplode_outer(F.regexp_extract_all("text", F.lit("(?s)(.)"), F.lit(1))).alias("pos", "ch"))
    mapped = points.join(F.broadcast(fold_table(spark)), "ch", "left")
    part = F.when(F.col("ch").isNull(), F.lit(None)).otherwise(F.coalesce("parts", F.array(F.struct(F.col("ch").alias("part"), F.lit(0).alias("ccc")))))
    whole = mapped.select("tid", F.struct("pos", part.alias("parts")).alias("p")).groupBy("tid").agg(F.sort_array(F.collect_list("p")).alias("ps"))
    flat = F.flatten(F.filter(F.col("ps.parts"), lambda x: x.isNotNull()))
    return texts.join(whole.select("tid", flat.alias("parts")).select("tid", _rebuilt(F.col("parts")).alias("form")), "tid")


def text_forms(texts: DataFrame, **more: Column) -> DataFrame:
    """(text, tid, form) of every distinct non-null ``text``, and the aggregates ``more`` over its rows, written once."""
    count = [c.alias(n) for n, c in more.items()] or [F.lit(None).alias("_")]
    own = texts.where("text is not null").groupBy("text").agg(*count).withColumn("tid", text_id(F.col("text"))).select("text", "tid", *more)
    return written(forms(written(own, "texts")).select("text", "tid", "form", *more), "forms")


def alike_annotations(annotations: DataFrame, known: DataFrame) -> DataFrame:
    """Pairs of annotations of one utterance whose raw texts have one form but differ: (key_a, key_b), smaller first.

    Only forms written in two ways within an utterance are paired, so runs of equal texts are not paired with each
    other. Null texts, ids and utterance keys make no pair; redelivered rows count once.
    """
    rows = annotations.where("raw_text is not null and ann_id is not null").select("dataset", "stem", "ann_id", text_id(F.col("raw_text")).alias("tid")).distinct()
    keyed = rows.join(known, "tid").select("dataset", "stem", text_id(F.col("form")).alias("fid"), "ann_id", "tid")
    key = ["dataset", "stem", "fid"]
    several = keyed.groupBy(*key).agg(F.min("tid").alias("a"), F.max("tid").alias("b")).where("a <> b").select(*key)
    few = keyed.join(several, key, "left_semi")
    left, right = few.alias("a"), few.alias("b")
    same = F.expr("a.dataset = b.dataset and a.stem = b.stem and a.fid = b.fid and a.ann_id < b.ann_id and a.tid <> b.tid")
    return left.join(right, same).select(F.col("a.ann_id").alias("key_a"), F.col("b.ann_id").alias("key_b")).distinct()


def lookalikes(annotations: DataFrame, intervals: DataFrame, lexicon: DataFrame) -> DataFrame:
    """(src, key_a, key_b) for annotations of one utterance and for words against the lexicon.

    ``annotation``: pairs of ``alike_annotations``. ``interval``: line_no of a lexicon token and id of an interval whose
    text is no token but has the form of that one; distinct texts are compared first, and only those found are joined
    back to their rows. A tier named ``words`` in any letter case is used. Empty tables give no rows; extra columns
    are ignored.
    """
    words = intervals.where(F.lower("tier") == "words").select("interval_id", "text")
    none = F.lit(None).cast("bigint").alias("line")
    texts = words.select("text", F.lit(True).alias("word"), none).unionByName(annotations.select(F.col("raw_text").alias("text"), F.lit(False).alias("word"), none))
    texts = texts.unionByName(lexicon.select(F.col("token").alias("text"), F.lit(False).alias("word"), F.col("line_no").cast("bigint").alias("line")))
    known = text_forms(texts, word=F.max("word"), token=F.count("line") > 0, line=F.min("line"))
    a = alike_annotations(annotations, known.select("tid", "form")).select(F.lit("annotation").alias("src"), "key_a", "key_b")
    hits = known.where("word and not token").select("text", "form").join(known.where("token").select("form", F.col("line").alias("key_a")), "form").select("text", "key_a")
    b = words.where("interval_id is not null").join(hits, "text").select(F.lit("interval").alias("src"), "key_a", F.col("interval_id").alias("key_b")).distinct()
    return a.unionByName(b)
