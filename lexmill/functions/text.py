"""Column functions of the legal-text vocabulary: numerals, ordinals, white space, escaping."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Flags that make Java's classes and case folding cover Cyrillic and the no-break space.
U = "(?U)"
IU = "(?iuU)"
#: Parts runs of letters that a pattern found (never put into texts).
MARK = "\u0001"


def _roman(n: int) -> str:
    out = ""
    for value, sign in ((10, "X"), (9, "IX"), (5, "V"), (4, "IV"), (1, "I")):
        while n >= value:
            out, n = out + sign, n - value
    return out


#: Roman numerals that are known: I to XXV, and XXX; others count as 0.
ROMAN = {_roman(n): n for n in [*range(1, 26), 30]}
#: Stems of ordinal words one to twenty (fixed values), longest first where one begins another.
ORDINALS = {
    "перв": 1, "втор": 2, "трет": 3, "четверт": 4, "пят": 5, "шест": 6, "седьм": 7, "восьм": 8, "девят": 9, "десят": 10,
    "одиннадцат": 11, "двенадцат": 12, "тринадцат": 13, "четырнадцат": 14, "пятнадцат": 15, "шестнадцат": 16,
    "семнадцат": 17, "восемнадцат": 18, "девятнадцат": 19, "двадцат": 20,
}
ENDING = "(?:ая|ой|ую|ый|ого|ому|ым|ом|ий|ья|ьей|ью|ье|ьего|ьему|ьим|ьем|ые|ых|ыми|ьи|ьих|ьими)"
ORDINAL = f"(?:{'|'.join(sorted(ORDINALS, key=len, reverse=True))}){ENDING}"


def _mapped(values: dict[str, int], key: Column) -> Column:
    pairs = [F.lit(x) for kv in values.items() for x in kv]
    return F.element_at(F.create_map(*pairs), key)


def roman(c: Column) -> Column:
    """The value of a Roman numeral, 0 if it is none of ``ROMAN``."""
    return F.coalesce(_mapped(ROMAN, F.upper(F.btrim(c))), F.lit(0))


def ordinal(c: Column) -> Column:
    """The number of an ordinal word in any case form; null if it is none."""
    return _mapped(ORDINALS, F.regexp_extract(F.lower(c), f"^({'|'.join(sorted(ORDINALS, key=len, reverse=True))}){ENDING}$", 1))


def collapse(c: Column) -> Column:
    """White space of any kind as single blanks, none at the ends."""
    return F.btrim(F.regexp_replace(c, rf"{U}\s+", " "))


def blank(c: Column) -> Column:
    return ~F.coalesce(c, F.lit("")).rlike(rf"{U}\S")


def escape(c: Column) -> Column:
    """Text as HTML text."""
    return F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
