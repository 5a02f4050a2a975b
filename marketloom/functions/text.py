"""Text, size, code and price expressions: Column to Column, all within Spark's own functions."""

from __future__ import annotations

import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from marketloom.schema import SIZE

# Letters and signs that stand for several, and letters that don't decompose.
EXPANSIONS = {
    "ß": "ss", "ẞ": "SS", "œ": "oe", "Œ": "OE", "æ": "ae", "Æ": "AE", "½": "1/2", "¼": "1/4", "¾": "3/4", "®": "(r)", "©": "(c)", "™": "(tm)", "×": "*", "÷": "/", "…": "...", "№": "No",
    "Þ": "TH", "þ": "th", "«": "<<", "»": ">>", "±": "+/-", "¡": "!", "¿": "?", "„": ",,", "‚": ",", "‹": "<", "›": ">", "Ĳ": "IJ", "ĳ": "ij", "ŉ": "'n", "⅓": "1/3", "⅔": "2/3", "⅛": "1/8", "℃": "°C", "ℓ": "l",
}
SINGLES = {"đ": "d", "Đ": "D", "ø": "o", "Ø": "O", "ł": "l", "Ł": "L", "ħ": "h", "Ħ": "H", "ŧ": "t", "Ŧ": "T", "ı": "i", "ð": "d", "Ð": "D", "ŋ": "n", "Ŋ": "N", "ſ": "s", "ĸ": "q", "ƒ": "f", "ŀ": "l", "Ŀ": "L", "‘": "'", "’": "'", "“": '"', "”": '"', "–": "-", "—": "-"}
# Words for units, and what makes a key.
UNIT_WORDS = {
    "kg": ("kg", 1), "kilograme": ("kg", 1), "kilogram": ("kg", 1), "g": ("g", 1), "gr": ("g", 1), "grame": ("g", 1), "mg": ("g", 0.001),
    "l": ("l", 1), "litri": ("l", 1), "litru": ("l", 1), "ml": ("ml", 1), "mililitri": ("ml", 1), "cl": ("ml", 10),
    "buc": ("buc", 1), "bucati": ("buc", 1), "bucata": ("buc", 1), "set": ("buc", 1),
}
KEY_UNITS = ["kg", "kilograme", "g", "grame", "gr", "ml", "mililitri", "cl", "l", "litri", "litru", "buc", "bucati", "bucăți"]
# Brands that are none, words for being in stock, words of gift sets.
PLACEHOLDER_BRANDS = ["non-brand", "nonbrand", "non brand", "no brand", "nobrand", "dummymarke", "dummy", "dummy brand", "marke", "generic", "generico", "fara marca", "n/a", "na", "none", "null", "-", "--"]
AVAILABLE = ["instock", "instoreonly", "limitedavailability", "onlineonly", "presale"]
BUNDLE_OBJECTS = "pahar|pahare|halba|halbe|geanta|tricou|sosete|carte|colorat|ceasca|cesti|farfuri|cana|cani|jucari|breloc|umbrel|prosop|minge|sapca|figurin|magnet|termos|boxa|casti|stickere|suport|tava|caciul|fular"
BUNDLE_ENDS = r"pahar|pahare|halba|halbe|geanta|tricou|sosete|carte|colorat|ceasca|jucari|breloc|umbrel|minge|sapca|figurin|magnet|caciul|fular|\bbol\b"
CONSUMABLES = "bere|vin|whisk|coniac|brandy|vodka|vodca|gin|rom|lichior|aperitiv|digestiv|campari|baileys|metaxa|cafea|ceai|ciocolat|bautur|suc|apa|lapte|cereale|biscuit|bomboan|nesquik|chips"

_SPACE = r"[\s ]+"


def _alternatives(words) -> str:
    """Longest first: the first alternative that matches wins."""
    return "|".join(sorted(words, key=lambda w: (-len(w), w)))


@lru_cache
def _letters() -> tuple[str, str]:
    """Accented Latin letters, and each one's base."""
    pairs = dict(SINGLES)
    for code in (*range(0xC0, 0x250), *range(0x1E00, 0x1F00)):
        base = "".join(c for c in unicodedata.normalize("NFD", chr(code)) if not unicodedata.combining(c))
        if len(base) == 1 and base.isascii() and chr(code) not in EXPANSIONS:
            pairs.setdefault(chr(code), base)
    return "".join(pairs), "".join(pairs.values())


@lru_cache
def _decomposed() -> tuple[str, str]:
    """The letters that decompose into a base and marks, and each one's base."""
    whole, bases = _letters()
    pairs = [(a, b) for a, b in zip(whole, bases) if a not in SINGLES]
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


def _base_letters(text: Column, letters: tuple[str, str]) -> Column:
    return F.regexp_replace(F.translate(text, *letters), r"\p{M}+", "")


def squeeze(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, _SPACE, " "))


def fold(text: Column) -> Column:
    """Without accents, lower case, single spaces; null is empty."""
    plain = text = F.coalesce(text, F.lit(""))
    for sign, spelled in EXPANSIONS.items():
        text = F.replace(text, F.lit(sign), F.lit(spelled))
    # A text of as many bytes as letters is ASCII, of which no sign or letter stands for another: most are.
    return squeeze(F.lower(F.when(F.octet_length(plain) == F.length(plain), plain).otherwise(_base_letters(text, _letters()))))


def key_fold(text: Column) -> Column:
    """The fold with everything but letters, digits and the per cent sign flattened to spaces."""
    return F.trim(F.regexp_replace(fold(text), "[^a-z0-9%]+", " "))


def number_key(value: Column) -> Column:
    """Three decimals at most, no trailing zeros."""
    return F.regexp_replace(value.cast(SIZE).cast("string"), r"\.?0+$", "")


def canonical_quantity(quantity: Column, unit: Column) -> Column:
    q = quantity.cast(SIZE)
    base = F.when(unit.isin("kg", "g"), "g:").when(unit.isin("l", "ml"), "ml:").when(unit == "buc", "buc:")
    scaled = F.when(unit.isin("kg", "l"), (q * 1000).cast(SIZE)).otherwise(q)
    return F.coalesce(F.concat(base, number_key(scaled)), F.lit("-"))


def strip_quantity(name: Column) -> Column:
    """The name without its size, so that the size counts once in the key."""
    start, end = r"(?<![\p{L}\p{N}_])", r"(?![\p{L}\p{N}_])"
    text = F.coalesce(name, F.lit(""))
    text = F.regexp_replace(text, rf"(?iu)(\+/-|\+-|±|{start}cca{end}|{start}aprox\.?{end}|{start}ca\.)", " ")
    text = F.regexp_replace(text, rf"(?iu)({start}\d+\s*x\s*)?\d+([.,]\d+)?\s*({_alternatives(KEY_UNITS)}){end}", " ")
    text = F.regexp_replace(text, r"\s*[,;·/+-]+\s*(?=[,;·/+-]|$)|^\s*[,;·/+-]+\s*", " ")
    return squeeze(text)


def merge_key(brand: Column, name: Column, quantity: Column, unit: Column) -> Column:
    return F.concat_ws("|", key_fold(brand), key_fold(strip_quantity(name)), canonical_quantity(quantity, unit))


def parse_quantity(name: Column) -> Column:
    """struct(quantity, unit) of the last size in the name; null if there is none. The fold comes first, and with it × is *."""
    size = rf"(?:(\d+)\s*x\s*)?(\d+(?:[.,]\d+)?)\s*({_alternatives(UNIT_WORDS)})(?![\p{{L}}\p{{N}}_])"
    last = F.try_element_at(F.regexp_extract_all(fold(name), F.lit(size), F.lit(0)), F.lit(-1))
    part = lambda k: F.nullif(F.regexp_extract(last, size, k), F.lit(""))
    word = part(3)
    unit = F.element_at(F.create_map(*[F.lit(x) for w, (u, _) in UNIT_WORDS.items() for x in (w, u)]), word)
    factor = F.element_at(F.create_map(*[F.lit(x) for w, (_, f) in UNIT_WORDS.items() for x in (w, float(f))]), word)
    amount = F.replace(part(2), F.lit(","), F.lit(".")).cast("double")
    total = F.round(amount * factor * F.coalesce(part(1).cast("double"), F.lit(1.0)), 3)
    return F.when((total > 0) & (total <= 1_000_000), F.struct(total.cast(SIZE).alias("quantity"), unit.alias("unit")))


def valid_gtin(code: Column) -> Column:
    """8 to 14 digits whose check digit is right, or null."""
    digits = F.trim(code)
    padded = F.lpad(digits, 14, "0")
    total = sum((F.substring(padded, k + 1, 1).cast("int") * (3 if k % 2 == 0 else 1) for k in range(14)), F.lit(0))
    return F.when(digits.rlike("^[0-9]{8,14}$") & (total % 10 == 0), digits)


def usable_brand(brand: Column) -> Column:
    """Null for an empty, overlong or placeholder brand."""
    value = F.trim(brand)
    return F.when((value != "") & (F.length(value) <= 80) & ~fold(value).isin(PLACEHOLDER_BRANDS), value)


def unshout(text: Column) -> Column:
    lower = F.lower(text)
    return F.when(text == F.upper(text), F.concat(F.upper(F.substring(lower, 1, 1)), F.substring(lower, 2, 1 << 30))).otherwise(text)


def unshout_brand(brand: Column) -> Column:
    return F.when(brand == F.upper(brand), F.initcap(F.lower(brand))).otherwise(brand)


def https_url(url: Column, longest: int = 1000) -> Column:
    value = F.trim(url)
    value = F.when(value.startswith("//"), F.concat(F.lit("https:"), value)).otherwise(value)
    return F.when(value.startswith("https://") & (F.length(value) <= longest), value)


def parse_price(text: Column) -> Column:
    """The number in a text: digits with a decimal point or comma, thousands marks dropped; null if no number is left."""
    value = F.regexp_replace(F.regexp_replace(text, r"[^\d.,-]", ""), r"\.(?=\d{3}(?!\d))", "")
    comma = value.contains(",") & ~value.contains(".")
    plain = F.when(comma, F.regexp_replace(value, "^([^,]*),", "$1.")).otherwise(F.replace(value, F.lit(","), F.lit("")))
    return plain.try_cast("double")


def is_available(availability: Column) -> Column:
    value = F.lower(F.regexp_replace(availability, r"(?i)^https?://schema\.org/", ""))
    return F.coalesce(value.isin(AVAILABLE), F.lit(False))


def is_bundle(name: Column) -> Column:
    """Gift sets, and groceries sold with an object. Its own fold: marks that decompose go, other letters and spaces stay."""
    n = F.lower(_base_letters(F.coalesce(name, F.lit("")), _decomposed()))
    gift = n.rlike(r"\b(set|pachet|cutie|caseta)\s+(de\s+|pentru\s+)?cadou\b|\bgift\s*(set|box)\b")
    kitchen = n.rlike(r"^(set\s+\d+\s+boluri|set\s+carafa|carafa)\b")
    with_object = n.rlike(rf"\d+([.,]\d+)?\s?(l|ml|g|kg|cl)\b[^+]*\+[^+]*({BUNDLE_OBJECTS})")
    at_end = n.rlike(rf"\+[^+]*({BUNDLE_ENDS})[^+]*$") & (n.rlike(f"({CONSUMABLES})") | n.rlike(r"\d+([.,]\d+)?\s?(l|cl)\b"))
    return gift | (n.contains("+") & ~kitchen & (with_object | at_end))
