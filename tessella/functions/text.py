"""Scalar operators on transcripts: punctuation, numerals, tags, filters and value formats."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessella.functions.tokens import LABEL_TOKENS, VOCALISATIONS

# Punctuation that may stay, and its ASCII spellings.
ALLOWED = "，。！？、；：…"
ASCII_FORMS = dict(zip(",.?!;:", "，。？！；：", strict=True))
# Ideographic spellings of a name heard in recordings, and the name.
NAME_VARIANTS = ("瑞娅", "瑞亚", "瑞雅", "瑞啊")
NAME = "ria"
# Digits and their ideographs.
DIGITS = dict(zip("0123456789", "零一二三四五六七八九", strict=True))



def punct_inline(text: Column) -> Column:
    """ASCII punctuation becomes ideographic, other marks of the ideographic blocks become a comma, and of adjacent
    allowed marks the first stays."""
    plain = F.translate(text, "".join(ASCII_FORMS), "".join(ASCII_FORMS.values()))
    return F.regexp_replace(F.regexp_replace(plain, "[　-〿＀-￯&&[^" + ALLOWED + r"\p{Nd}]]", "，"), f"([{ALLOWED}])[{ALLOWED}]+", "$1")


def punct_grouped(text: Column) -> Column:
    """The table-wide variant: a lone mark that isn't allowed becomes a comma, and so does any group of two or more.

    Blanks, letters, digits, hyphens inside words and tag marks are no marks here.
    """
    plain = F.translate(text, "".join(ASCII_FORMS), "".join(ASCII_FORMS.values()))
    mark = r"[^\p{L}\p{M}\p{N}\s<>\[\]|_\-]"
    return F.regexp_replace(F.regexp_replace(plain, f"{mark}{{2,}}", "，"), f"(?![{ALLOWED}]){mark}", "，")


def digits_spelled(text: Column) -> Column:
    """Digits one by one as ideographs."""
    return F.translate(text, "".join(DIGITS), "".join(DIGITS.values()))


def digits_spelled_outside_tags(text: Column) -> Column:
    """As ``digits_spelled``, but not within brackets, tags or capital labels."""
    parts = F.regexp_extract_all(text, F.lit(r"(\[[^\]]*\]|<[^>]*>|[A-Z][A-Z0-9-]*[A-Z0-9]|[\s\S])"), F.lit(1))
    return F.array_join(F.transform(parts, lambda p: F.when(F.length(p) == 1, digits_spelled(p)).otherwise(p)), "")


# Units of places within four digits, and of every four digits; more digits than those reach are read one by one.
UNITS, GREAT_UNITS = ("", "十", "百", "千"), ("", "万", "亿", "万")
MOST_DIGITS = 16
#: Stretches of a text that are read as one, and what protects digits: brackets, tags and capital labels.
NUMERAL_PIECES = r"(\[[^\]]*\]|<[^>]*>|[A-Z][A-Z0-9-]*[A-Z0-9]|[0-9]+(?:\.[0-9]+)?%|[0-9]+/[0-9]+|(?:[0-9]{4}|[0-9]{2})年|[0-9]+(?:\.[0-9]+)?|[^0-9])"


def whole_number(digits: Column) -> Column:
    """A string of digits read as a number by place value, leading zeros aside; of more than sixteen digits one by one."""
    bare = F.ltrim(digits, F.lit("0"))
    n = F.length(bare)
    unit, great = F.array(*map(F.lit, UNITS)), F.array(*map(F.lit, GREAT_UNITS))

    def read(c: Column, i: Column) -> Column:
        place = n - 1 - i
        return F.concat(digits_spelled(c), F.when(c == "0", "").otherwise(F.get(unit, place % 4)), F.when(place % 4 == 0, F.get(great, F.floor(place / 4).cast("int"))).otherwise(""))

    said = F.array_join(F.transform(F.filter(F.split(bare, ""), lambda c: c != ""), read), "")
    for pattern, to in (("零+([万亿])", "$1"), ("亿万", "亿"), ("零+", "零"), ("零$", ""), ("^一十", "十")):
        said = F.regexp_replace(said, pattern, to)
    return F.when(n == 0, "零").when(n > MOST_DIGITS, digits_spelled(digits)).otherwise(said)


def numerals_spelled(text: Column) -> Column:
    """Numbers as they are read: whole ones and decimals, shares in percent, fractions, and years digit by digit.

    Brackets, tags and capital labels stay as they are, and so does a sign before a number.
    """
    number = lambda p: F.concat(whole_number(F.regexp_extract(p, "^([0-9]+)", 1)), F.when(p.contains("."), F.concat(F.lit("点"), digits_spelled(F.regexp_extract(p, r"\.([0-9]+)", 1)))).otherwise(""))

    def read(p: Column) -> Column:
        fraction = F.concat(whole_number(F.regexp_extract(p, "/([0-9]+)$", 1)), F.lit("分之"), whole_number(F.regexp_extract(p, "^([0-9]+)/", 1)))
        return (
            F.when(~p.rlike("^[0-9]"), p).when(p.endswith("年"), digits_spelled(p)).when(p.endswith("%"), F.concat(F.lit("百分之"), number(p)))
            .when(p.contains("/"), fraction).otherwise(number(p))
        )

    return F.array_join(F.transform(F.regexp_extract_all(text, F.lit(NUMERAL_PIECES), F.lit(1)), read), "")


def name_restored(text: Column) -> Column:
    """Ideographic spellings of the name in Latin letters."""
    for v in NAME_VARIANTS:
        text = F.replace(text, F.lit(v), F.lit(NAME))
    return text


def name_fragments_joined(text: Column) -> Column:
    """Pinyin fragments of the name in a line of tokens become the name."""
    return F.regexp_replace(F.regexp_replace(text, r"rui[0-5]\s+ya[0-5]", NAME), r"rui[0-5]\s+a[0-5]", NAME)


def label_token(label: Column) -> Column:
    """The token of a bracketed label's inner text; an unknown one in capitals, blanks as hyphens."""
    known = F.create_map(*[F.lit(x) for kv in LABEL_TOKENS.items() for x in kv])
    return F.coalesce(F.try_element_at(known, label), F.replace(F.upper(label), F.lit(" "), F.lit("-")))


def labels_to_tokens(text: Column) -> Column:
    """Every ``[Label]`` replaced by its token between blanks."""
    parts = F.regexp_extract_all(text, F.lit(r"(\[[^\]]+\]|[^\[]+|\[)"), F.lit(1))

    def one(p: Column) -> Column:
        inner = F.regexp_extract(p, r"^\[([^\]]+)\]$", 1)
        return F.when(inner != "", F.concat(F.lit(" "), label_token(inner), F.lit(" "))).otherwise(p)

    return F.array_join(F.transform(parts, one), "")


def supported_only(text: Column) -> Column:
    """Allowed marks, ideographs, letters, digits, hyphens, blanks and tag marks; the rest is taken out."""
    return F.regexp_replace(text, "[^" + ALLOWED + r"㐀-䶿一-鿿\p{L}\p{N}\s<>\[\]|\-]", "")


def has_kana(text: Column) -> Column:
    return text.rlike("[぀-ヿ]")


# Marks beside which an ellipsis gives way: allowed ones and their ASCII forms.
BESIDE_ELLIPSES = "，。！？、；：,.!?;:"
_PIECES = r"(…+|[A-Z][A-Z0-9-]*[A-Z0-9]|(?s:.))"
_TAGS_FIRST = r"^((?:<\|[^|]+\|>|\[[^\]]+\])*)…+"


def ellipses_thinned(text: Column) -> Column:
    """Runs of ellipses as one, each less one for every mark beside it: before, behind, or before a capital label before it."""
    pieces = F.regexp_extract_all(text, F.lit(_PIECES), F.lit(1))

    def shifted(by: int) -> Column:
        """The pieces moved back by so many places, or forward by one."""
        none = F.array_repeat(F.lit(""), by if by > 0 else 1)
        return F.slice(F.concat(none, pieces), 1, F.size(pieces)) if by > 0 else F.concat(F.slice(pieces, 2, F.size(pieces)), none)

    def thin(x: Column) -> Column:
        mark = lambda p: p.isin(*BESIDE_ELLIPSES)
        label = x["one"].rlike("^[A-Z][A-Z0-9-]*[A-Z0-9]$") & (mark(x["two"]) | ((x["two"] == "…") & mark(x["three"])))
        left = F.length(x["own"]) - sum(F.when(c, 1).otherwise(0) for c in (mark(x["after"]), mark(x["one"]), label))
        return F.when(~x["own"].startswith("…"), x["own"]).when(left > 0, "…").otherwise("")

    beside = F.arrays_zip(pieces.alias("own"), shifted(1).alias("one"), shifted(2).alias("two"), shifted(3).alias("three"), shifted(-1).alias("after"))
    return F.array_join(F.transform(beside, thin), "")


def ellipses_cleaned(text: Column) -> Column:
    """Ellipses thinned, none leads the text, and a bracketed label that is repeated after marks or blanks stays once."""
    label, marks = r"\[([A-Za-z][^\]]*?)\]", rf"[{BESIDE_ELLIPSES}…\-]+"
    bare = F.regexp_replace(ellipses_thinned(text), _TAGS_FIRST, "$1")
    moved = F.regexp_replace(bare, rf"{label}\s*({marks})\s*\[\1\]", "$2[$1]")
    return F.regexp_replace(moved, rf"{label}\s+\[\1\]", "[$1]")


def repeated_labels_joined(text: Column) -> Column:
    """Blanks become single, and of equal capital labels side by side one stays."""
    single = F.trim(F.regexp_replace(text, r"\s+", " "))
    return F.regexp_replace(single, r"\b([A-Z][A-Z0-9-]+)\s+\1\b", "$1")


# What leading tags may say.
LANGUAGES = ("zh", "en", "yue", "ja", "ko", "nospeech", "zh/en", "en/zh", "dialect", "minnan", "wuyu")
EMOTIONS = ("HAPPY", "SAD", "ANGRY", "NEUTRAL", "FEARFUL", "DISGUSTED", "SURPRISED", "EMO_UNKNOWN")
MODES = ("withitn", "woitn")


def tag_values(text: Column) -> dict[str, Column]:
    """Language, emotion and numeral mode of angle-and-bar tags; of several the last counts, null if there is none."""
    tags = F.regexp_extract_all(text, F.lit(r"<\|([^|]+)\|>"), F.lit(1))

    def last(values: tuple[str, ...]) -> Column:
        return F.try_element_at(F.filter(tags, lambda t: t.isin(*values)), F.lit(-1))

    return {"language": last(LANGUAGES), "emotion": last(EMOTIONS), "itn_mode": last(MODES)}


_LABEL = r"\[[A-Za-z][^\]]*?\]"


def label_events(text: Column) -> Column:
    """``[X]`` events with their character offset in the text as written: array of (type, char_position)."""
    gaps = F.transform(F.split(text, _LABEL), lambda p: F.length(p))
    kinds = F.regexp_extract_all(text, F.lit(r"\[([A-Za-z][^\]]*?)\]"), F.lit(1))
    total = lambda xs, extra: F.aggregate(xs, F.lit(0), lambda a, x: a + x + extra)
    return F.transform(
        kinds,
        lambda k, i: F.struct(
            k.alias("type"),
            (total(F.slice(gaps, 1, i + 1), 0) + total(F.transform(F.slice(kinds, 1, i), lambda x: F.length(x)), 2)).alias("char_position"),
        ),
    )


def without_tags(text: Column) -> Column:
    """The text without tags and label events, and without blanks around it."""
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(text, r"<\|[^|]+\|>", ""), _LABEL, ""), r"^\s+|\s+$", "")


def nth_char_removed(text: Column, char: str, n: int) -> Column:
    """The text without the n-th occurrence of a character, counted from 1; unchanged if there are fewer."""
    before = F.substring_index(text, char, n)
    there = (F.length(text) - F.length(F.replace(text, F.lit(char), F.lit("")))) >= n
    return F.when(there, F.concat(before, F.substr(text, F.length(before) + 2))).otherwise(text)


def vocalisations_marked(text: Column) -> Column:
    """Bare vocalisation names between angle brackets, longest name first, not inside a longer capital label."""
    names = "|".join(sorted(VOCALISATIONS, key=len, reverse=True))
    return F.regexp_replace(text, f"(?<![A-Z-])({names})(?![A-Z-])", "<$1>")


def quoted(text: Column) -> Column:
    """A value between quotes, its own quotes doubled."""
    return F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))


def seconds_text(value: Column) -> Column:
    """Six decimals, rounded half up, without zeros at the end, and without the sign of a value that rounds to 0."""
    return F.regexp_replace(F.regexp_replace(F.format_string("%.6f", value.cast("double")), r"\.?0+$", ""), "^-0$", "0")


def py_seconds_text(value: float) -> str:
    text = f"{value:.6f}".rstrip("0").rstrip(".")
    return "0" if text == "-0" else text


def text_units(text: Column) -> Column:
    """``word_units`` as a Column: an array."""
    return F.regexp_extract_all(text, F.lit(r"([一-鿿]|[[\p{L}\p{N}\-]&&[^一-鿿]]+|\S)"), F.lit(1))


def word_units(text: str) -> list[str]:
    """Ideographs one by one, letters with digits and hyphens together, any other character by itself; blanks part."""
    return re.findall(r"[一-鿿]|(?:(?![一-鿿])[^\W_]|-)+|[^\s]", text)
