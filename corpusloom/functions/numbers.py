"""Urdu number words as Column expressions (South Asian grouping), and the same for use inside UDFs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: the words and digits below must be exactly these ---
BELOW_100 = [
    "صفر", "ایک", "دو", "تین", "چار", "پانچ", "چھ", "سات", "آٹھ", "نو",
    "دس", "گیارہ", "بارہ", "تیرہ", "چودہ", "پندرہ", "سولہ", "سترہ", "اٹھارہ", "انیس",
    "بیس", "اکیس", "بائیس", "تیئیس", "چوبیس", "پچیس", "چھبیس", "ستائیس", "اٹھائیس", "انتیس",
    "تیس", "اکتیس", "بتیس", "تینتیس", "چونتیس", "پینتیس", "چھتیس", "سینتیس", "اڑتیس", "انتالیس",
    "چالیس", "اکتالیس", "بیالیس", "تینتالیس", "چوالیس", "پینتالیس", "چھیالیس", "سینتالیس", "اڑتالیس", "انچاس",
    "پچاس", "اکیاون", "باون", "ترپن", "چون", "پچپن", "چھپن", "ستاون", "اٹھاون", "انسٹھ",
    "ساٹھ", "اکسٹھ", "باسٹھ", "تریسٹھ", "چونسٹھ", "پینسٹھ", "چھیاسٹھ", "سڑسٹھ", "اڑسٹھ", "انہتر",
    "ستر", "اکہتر", "بہتر", "تہتر", "چوہتر", "پچہتر", "چھہتر", "ستتر", "اٹھتر", "اناسی",
    "اسی", "اکیاسی", "بیاسی", "تراسی", "چوراسی", "پچاسی", "چھیاسی", "ستاسی", "اٹھاسی", "نواسی",
    "نوے", "اکانوے", "بانوے", "ترانوے", "چورانوے", "پچانوے", "چھیانوے", "ستانوے", "اٹھانوے", "ننانوے",
]
HUNDRED = "سو"
SCALES = [(10**11, "کھرب"), (10**9, "ارب"), (10**7, "کروڑ"), (10**5, "لاکھ"), (10**3, "ہزار")]
ORDINALS = {1: "پہلا", 2: "دوسرا", 3: "تیسرا", 4: "چوتھا", 6: "چھٹا", 9: "نواں"}
ORDINAL_SUFFIX, MINUS, POINT = "واں", "منفی", "اعشاریہ"
OCLOCK, HALF_PAST, QUARTER_PAST, QUARTER_TO = "بجے", "ساڑھے", "سوا", "پونے"
HALF_PAST_1, HALF_PAST_2, PAST, MINUTES = "ڈیڑھ", "ڈھائی", "بج کر", "منٹ"
URDU_DIGITS, ARABIC_DIGITS, ARABIC_SEPARATORS = "۰۱۲۳۴۵۶۷۸۹", "٠١٢٣٤٥٦٧٨٩", "٫٬"
# --- end of fixed values ---

#: The first number without words.
LIMIT = 10**14


def ascii_digits(text: Column) -> Column:
    """Urdu and Arabic-Indic digits and the Arabic separators as ASCII."""
    return F.translate(text, URDU_DIGITS + ARABIC_DIGITS + ARABIC_SEPARATORS, "0123456789" * 2 + ".,")


def strip_thousands(text: Column) -> Column:
    """Without separators between a digit and a group of three digits."""
    return F.regexp_replace(text, r"(?<=\d)[,٬](?=\d{3}\b)", "")


def _small(n: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, BELOW_100)), n.cast("int") + 1)


def _below_1000(n: Column) -> Column:
    n = n.cast("long")
    h, r = F.floor(n / 100), n % 100
    hundreds = F.when(h > 0, F.concat(_small(h), F.lit(f" {HUNDRED}")))
    return F.concat_ws(" ", hundreds, F.when((r > 0) | (n == 0), _small(r)))


def cardinal(n: Column) -> Column:
    """Words of a whole number; an error from LIMIT on."""
    n = n.cast("long")
    rest, parts = F.abs(n), []
    for scale, name in SCALES:
        q = ((rest - rest % scale) / scale).cast("long")
        parts.append(F.when(q > 0, F.concat(_below_1000(q), F.lit(f" {name}"))))
        rest = rest % scale
    words = F.concat_ws(" ", F.when(n < 0, MINUS), *parts, F.when((rest > 0) | (n == 0), _below_1000(rest)))
    return F.when(F.abs(n) < LIMIT, words).when(n.isNotNull(), F.raise_error(F.concat(F.lit("no words for "), n.cast("string"))))


def ordinal(n: Column) -> Column:
    own = F.create_map(*(F.lit(x) for kv in ORDINALS.items() for x in kv))
    return F.coalesce(F.try_element_at(own, n.cast("int")), F.concat(cardinal(n), F.lit(ORDINAL_SUFFIX)))


def digit_by_digit(text: Column) -> Column:
    digits = F.filter(F.split(text, ""), lambda c: c.rlike("^[0-9]$"))
    return F.array_join(F.transform(digits, lambda c: _small(c)), " ")


def decimal(text: Column) -> Column:
    """Words of a decimal number in any of the digits; what follows the point is read digit by digit."""
    t = F.replace(ascii_digits(text), F.lit(","), F.lit(""))
    body = F.ltrim(F.translate(t, "+-", "  "))
    whole, part = F.substring_index(body, ".", 1), F.regexp_extract(body, r"\.(.*)$", 1)
    words = F.concat_ws(" ", F.when(t.startswith("-"), MINUS), cardinal(F.when(whole == "", "0").otherwise(whole)))
    return F.when(body.contains("."), F.concat(words, F.lit(f" {POINT} "), digit_by_digit(part))).otherwise(words)


def year(y: Column) -> Column:
    """1100 to 1999 in hundreds, other years as cardinals."""
    h = F.concat(_small(F.floor(y / 100)), F.lit(f" {HUNDRED}"))
    return F.when(y.between(1100, 1999), F.concat_ws(" ", h, F.when(y % 100 > 0, _small(y % 100)))).otherwise(cardinal(y))


def clock(hour: Column, minute: Column) -> Column:
    """Time of day on the 12-hour clock, with the words for halves and quarters."""
    h = F.pmod(hour - 1, F.lit(12)) + 1
    w = _small(h)
    half = F.when(h == 1, HALF_PAST_1).when(h == 2, HALF_PAST_2).otherwise(F.concat(F.lit(f"{HALF_PAST} "), w))
    return (
        F.when(minute == 0, F.concat(w, F.lit(f" {OCLOCK}")))
        .when(minute == 30, half)
        .when(minute == 15, F.concat(F.lit(f"{QUARTER_PAST} "), w))
        .when(minute == 45, F.concat(F.lit(f"{QUARTER_TO} "), _small(h % 12 + 1)))
        .otherwise(F.concat_ws(" ", w, F.lit(PAST), _small(minute), F.lit(MINUTES)))
    )


#: A table of scales down to the hundreds: what stands before a scale is a number itself.
_STEPS = [*SCALES, (100, HUNDRED)]
_CLOCK = {0: f"{{h}} {OCLOCK}", 15: f"{QUARTER_PAST} {{h}}", 30: f"{HALF_PAST} {{h}}", 45: f"{QUARTER_TO} {{next}}"}


def spell(n: int) -> str:
    """The words of :func:`cardinal` for a Python value, for text functions that must look around a number."""
    if n < 0:
        return f"{MINUS} {spell(-n)}"
    if n >= LIMIT:
        raise ValueError(f"no words for {n}")
    for scale, name in _STEPS:
        if n >= scale:
            return " ".join([spell(n // scale), name, *([spell(n % scale)] if n % scale else [])])
    return BELOW_100[n]


def spell_decimal(text: str) -> str:
    """:func:`decimal` for ASCII digits: what follows the point is read digit by digit."""
    whole, *part = text.split(".", 1)
    return f" {POINT} ".join([spell(int(whole or 0)), *(" ".join(BELOW_100[int(d)] for d in p) for p in part)])


def spell_year(y: int) -> str:
    return " ".join([BELOW_100[y // 100], HUNDRED, *([BELOW_100[y % 100]] if y % 100 else [])]) if 1100 <= y <= 1999 else spell(y)


def spell_clock(hour: int, minute: int) -> str:
    h = hour % 12 or 12
    short = {1: HALF_PAST_1, 2: HALF_PAST_2}.get(h) if minute == 30 else None
    form = short or _CLOCK.get(minute, f"{{h}} {PAST} {{m}} {MINUTES}")
    return form.format(h=BELOW_100[h], next=BELOW_100[h % 12 + 1], m=BELOW_100[minute])
