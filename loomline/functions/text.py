"""String functions as column expressions. Character classes are spelled out, so that they mean the
same in every regex engine; Unicode classes are used where noted."""

from __future__ import annotations

import functools
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space in the Unicode sense, with the four separators that Python counts too.
SPACE = r"[\t-\r\x{1c}- \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"

# Replacements of punctuation of other scripts; the entry for the full-width digit one is as specified.
UNICODE_PUNCT = {
    "，": ",", "。": ".", "、": ",", "„": '"', "”": '"', "“": '"', "«": '"', "»": '"', "１": '"', "」": '"', "「": '"', "《": '"', "》": '"', "´": "'",
    "∶": ":", "：": ":", "？": "?", "！": "!", "（": "(", "）": ")", "；": ";", "–": "-", "—": " - ", "．": ". ", "～": "~", "’": "'", "…": "...",
    "━": "-", "〈": "<", "〉": ">", "【": "[", "】": "]", "％": "%", "►": "-",
}
#: Punctuation that counts as such in the character ratios.
PUNCT = r"""[!-/:-@\[-`{-~—|–]"""
EMOJI = r"[\x{231A}-\x{231B}\x{23E9}-\x{23F3}\x{25FD}-\x{25FE}\x{2600}-\x{27BF}\x{2B50}\x{2B55}\x{1F004}\x{1F0CF}\x{1F18E}\x{1F191}-\x{1F19A}\x{1F1E6}-\x{1F1FF}\x{1F201}-\x{1F265}\x{1F300}-\x{1F64F}\x{1F680}-\x{1F6FF}\x{1F7E0}-\x{1F7EB}\x{1F90C}-\x{1FAFF}]"
URL = r"(?i)https?://(?:[a-z0-9$-_@.&+!*(),]|%[0-9a-f]{2})+"
HASHTAG = r"[#@][A-Za-z0-9_]{4,}"

# Code point ranges of the scripts.
SCRIPTS = {
    "Arab": ((0x0600, 0x06FF), (0x0750, 0x077F), (0x0870, 0x089F), (0x08A0, 0x08FF)), "Armn": ((0x0530, 0x058F),), "Bali": ((0x1B00, 0x1B7F),),
    "Beng": ((0x0980, 0x09FF),), "Bugi": ((0x1A00, 0x1A1F),), "Cans": ((0x1400, 0x167F), (0x18B0, 0x18FF), (0x11AB0, 0x11ABF)),
    "Cyrl": ((0x0400, 0x04FF), (0x0500, 0x052F), (0x2DE0, 0x2DFF), (0xA640, 0xA69F), (0x1C80, 0x1C8F)), "Deva": ((0x0900, 0x097F), (0xA8E0, 0xA8FF)),
    "Ethi": ((0x1200, 0x137F), (0x1380, 0x139F), (0x2D80, 0x2DDF), (0x1E7E0, 0x1E7FF), (0xAB00, 0xAB2F)), "Geor": ((0x10A0, 0x10FF), (0x1C90, 0x1CBF), (0x2D00, 0x2D2F)),
    "Grek": ((0x0370, 0x03FF), (0x1F00, 0x1FFF)), "Gujr": ((0x0A80, 0x0AFF),), "Guru": ((0x0A00, 0x0A7F),), "Han": ((0x3300, 0x33FF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF)),
    "Hang": ((0x1100, 0x11FF), (0xA960, 0xA97F), (0xAC00, 0xD7AF), (0xD7B0, 0xD7FF), (0x3130, 0x318F), (0xFFA0, 0xFFDC)), "Hebr": ((0x0590, 0x05FF),), "Java": ((0xA980, 0xA9DF),),
    "Jpan": ((0x3040, 0x309F), (0x30A0, 0x30FF), (0xFF60, 0xFF97)), "Khmr": ((0x1780, 0x17FF), (0x19E0, 0x19FF)), "Knda": ((0x0C80, 0x0CFF),), "Laoo": ((0x0E80, 0x0EFF),),
    "Latn": ((0x0000, 0x024F), (0x10780, 0x107BF), (0x1E00, 0x1EFF), (0x0250, 0x02AF), (0xA720, 0xA7FF), (0xAB30, 0xAB6F)), "Marc": ((0x11C70, 0x11CBF),), "Mlym": ((0x0D00, 0x0D7F),),
    "Mong": ((0x1800, 0x18AF), (0x11660, 0x1167F)), "Mtei": ((0xAAE0, 0xAAF6), (0xABC0, 0xABFF)), "Mymr": ((0x1000, 0x109F), (0xA9E0, 0xA9FF), (0xAA60, 0xAA7F)), "Nkoo": ((0x07C0, 0x07FF),),
    "Olck": ((0x1C50, 0x1C7F),), "Orya": ((0x0B00, 0x0B7F),), "Phag": ((0xA840, 0xA87F),), "Sinh": ((0x0D80, 0x0DFF),), "Sund": ((0x1B80, 0x1BBF), (0x1CC0, 0x1CCF)),
    "Taml": ((0x0B80, 0x0BFF), (0x11FC0, 0x11FFF)), "Telu": ((0x0C00, 0x0C7F),), "Tfng": ((0x2D30, 0x2D7F),), "Thai": ((0x0E00, 0x0E7F),), "Tibt": ((0x0F00, 0x0FFF),),
}
#: ASCII characters that tell nothing of a script: white space, punctuation, digits.
SCRIPTLESS = r"[\t-\r -@\[-`{-~]"


def let(value: Column, body) -> Column:
    """Bind a value that the body uses several times, so that it is computed once."""
    return F.get(F.transform(F.array(value), body), 0)


def script_class(name: str) -> str:
    return "[" + "".join(f"\\x{{{a:X}}}-\\x{{{b:X}}}" for a, b in SCRIPTS[name]) + "]"


def normalize_whitespace(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, SPACE + "+", " "))


def replace_unicode_punct(c: Column) -> Column:
    one = {k: v for k, v in UNICODE_PUNCT.items() if len(v) == 1}
    out = F.translate(c, "".join(one), "".join(one.values()))
    for k, v in UNICODE_PUNCT.items():
        if len(v) > 1:
            out = F.replace(out, F.lit(k), F.lit(v))
    return out


def remove_unicode_punct(c: Column) -> Column:
    return F.translate(c, "".join(UNICODE_PUNCT), "")


@functools.cache
def _accents() -> tuple[str, str]:
    """Characters that decompose to one base character with marks, and their base characters: accented letters, voiced
    kana, compatibility ideographs. Hangul syllables decompose to several letters and stay whole."""
    pairs = []
    for n in (*range(0xC0, 0xD800), *range(0xE000, 0x10000)):
        d = [x for x in unicodedata.normalize("NFD", chr(n)) if unicodedata.category(x) != "Mn"]
        if len(d) == 1 and d[0] != chr(n):
            pairs.append((chr(n), d[0]))
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


def strip_accents(c: Column) -> Column:
    """Letters without their accents: composed characters are mapped to their base, loose marks dropped. Hangul
    syllables stay composed."""
    return F.regexp_replace(F.translate(c, *_accents()), r"\p{Mn}", "")


def remove_non_printing(c: Column) -> Column:
    return F.regexp_replace(c, r"[\x00-\x1f\x7f-\x{9f}]", "")


def replace_non_printing(c: Column, by: str = " ") -> Column:
    """Unicode categories C: control, format, surrogate, private, unassigned."""
    return F.regexp_replace(c, r"\p{C}", by)


def normalize(c: Column, accent: bool = True, case: bool = True, numbers: bool = True, punct: int = 1) -> Column:
    out = F.trim(c)
    out = F.lower(out) if case else out
    out = strip_accents(out) if accent else out
    out = F.regexp_replace(out, r"\p{Nd}", "0") if numbers else out
    out = replace_unicode_punct(out) if punct == 1 else remove_unicode_punct(out) if punct == 2 else out
    return remove_non_printing(out)


def normalize_for_dedup(c: Column, accent: bool = True) -> Column:
    out = remove_unicode_punct(F.regexp_replace(F.lower(c), r"\p{Nd}", "0"))
    return strip_accents(out) if accent else out


def balance_quotes(c: Column) -> Column:
    """Drop a lone quotation mark at the start, then one at the end."""
    marks = lambda x: F.length(x) - F.length(F.replace(x, F.lit('"'), F.lit("")))
    lead = F.when((marks(c) == 1) & c.startswith('"'), F.substring(c, F.lit(2), F.length(c))).otherwise(c)
    return F.when((marks(lead) == 1) & lead.endswith('"'), F.substring(lead, F.lit(1), F.length(lead) - 1)).otherwise(lead)


def normalize_line(c: Column) -> Column:
    return balance_quotes(remove_non_printing(replace_unicode_punct(normalize_whitespace(c))))


def spacing_steps(language: str = "en") -> list[tuple[str, str]]:
    """Patterns and replacements, in order, that set spacing and quotation marks as a tokenizer of the language expects them."""
    # The rules as specified.
    steps: list[tuple[str, str]] = [
        (r"\r", ""), (r"\(", " ("), (r"\)", ") "), (r"\) ([.!:?;,])", ")$1"), (r"\( ", "("), (r" \)", ")"), (r"(\d) %", "$1%"), (r" ([:;])", "$1"), ("`", "'"), ("''", ' " '),
        ("[„“”]", '"'), ("–", "-"), ("—", " - "), ("´", "'"), ("[‘‚’]", '"'), ("…", "..."), (" « ", ' "'), ("« ?", '"'), (" » ", '" '), (" ?»", '"'),
        (" %", "%"), (" ([:?!;])", "$1"), ("．", ". "),
    ]
    steps += [(r'"([,.]+)', '$1"')] if language == "en" else [] if language in ("cs", "cz") else [(',"', '",'), (r'(\.+)"(\s*[^<])', '"$1$2')]
    steps += [(r"(\d) (\d)", "$1,$2" if language in ("de", "es", "cz", "cs", "fr") else "$1.$2")]
    return steps


def normalize_spacing(c: Column, language: str = "en") -> Column:
    """Spacing and quotation marks as a tokenizer of the language expects them."""
    for pattern, by in spacing_steps(language):
        c = F.regexp_replace(c, pattern, by)
    return c


def replace_urls(c: Column, by: str = " ") -> Column:
    return F.regexp_replace(c, URL, by)


def replace_hashtags(c: Column, by: str = " ") -> Column:
    return F.regexp_replace(c, HASHTAG, by)


def emoji_pattern(by: str = "") -> str:
    """Emoji, keycaps and flags of regions, with the joiners, variation signs, skin tones and tags that belong to them; removed
    without trace, also the white space after them."""
    tail = r"[\x{FE0E}\x{FE0F}\x{200D}\x{1F3FB}-\x{1F3FF}\x{E0020}-\x{E007F}]"
    one = rf"(?:{EMOJI}|[0-9#*]\x{{FE0F}}?\x{{20E3}})"
    return rf"{one}{tail}*{SPACE}*" if by == "" else rf"{one}{tail}*"


def demojize(c: Column, by: str = "") -> Column:
    return F.regexp_replace(c, emoji_pattern(by), by)


def char_ngrams(c: Column, order: int) -> Column:
    """Character n-grams of a text without blanks; a shorter text has none."""
    parts = lambda bare: F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.length(bare) - order + 1)), lambda i: F.substring(bare, i, F.lit(order)))
    return let(F.replace(c, F.lit(" "), F.lit("")), lambda bare: F.when(bare.isNull(), F.lit(None)).when(F.length(bare) < order, F.expr("array()").cast("array<string>")).otherwise(parts(bare)))


def shingles(c: Column, order: int = 5) -> Column:
    """Distinct character n-grams, blanks included; of a shorter text the text itself."""
    parts = F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.length(c) - order + 1)), lambda i: F.substring(c, i, F.lit(order)))
    return F.when(c.isNotNull(), F.array_distinct(parts))


def count_of(c: Column, pattern: str) -> Column:
    return F.regexp_count(c, F.lit(pattern))


def longest_run(c: Column) -> Column:
    """Length of the longest run of one character; 0 of an empty text."""
    runs = F.regexp_extract_all(c, F.lit(r"(?s)(.)\1*"), F.lit(0))
    return F.coalesce(F.array_max(F.transform(runs, F.length)), F.lit(0))


def script_counts(c: Column) -> Column:
    one = lambda bare, n: F.struct(count_of(bare, script_class(n)).alias("n"), F.lit(n).alias("script"))
    # a text of one script, the usual case, needs one look
    latin = lambda bare: F.array(F.struct(F.length(bare).alias("n"), F.lit("Latn").alias("script")))
    return let(F.regexp_replace(c, SCRIPTLESS, ""), lambda bare: F.when(bare.rlike("^" + script_class("Latn") + "*$"), latin(bare)).otherwise(F.array(*(one(bare, n) for n in SCRIPTS))))


def predict_script(counts: Column) -> Column:
    """struct(script, share) of script_counts(); null and 0 without letters or where all present scripts tie."""
    return let(F.filter(counts, lambda x: x["n"] > 0), _script_of)


def _script_of(seen: Column) -> Column:
    total = F.aggregate(seen, F.lit(0), lambda a, x: a + x["n"])
    # of equal counts the first name wins
    top = F.get(F.array_sort(F.transform(seen, lambda x: F.struct((-x["n"]).alias("n"), x["script"].alias("script")))), 0)
    tie = (F.size(seen) > 1) & (F.size(seen) * -top["n"] == total)
    ok = (total > 0) & ~tie
    return F.struct(F.when(ok, top["script"]).alias("script"), F.when(ok, -top["n"] / total).otherwise(F.lit(0.0)).alias("share"))


def toxicity_tokens(c: Column) -> Column:
    """Words and signs apart by single blanks, with blanks around."""
    apart = F.regexp_replace(c, r"([\p{P}\p{S}\p{IsHan}])", " $1 ")
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(apart, SPACE + "+", " ")), F.lit(" "))


def listed(c: Column, words: list[str]) -> Column:
    """Entries of a word list that a tokenized text contains."""
    return let(c, lambda t: F.filter(F.array(*(F.lit(w) for w in words)), lambda w: F.contains(t, F.concat(F.lit(" "), w, F.lit(" ")))))


def toxicity_count(c: Column, words: list[str], tokenizer=None) -> Column:
    """Distinct list entries contained, as written or in lower case, whichever is more. tokenizer: a function of
    a column that sets words apart by single blanks, with blanks around."""
    cut = tokenizer or toxicity_tokens
    return F.greatest(F.size(listed(cut(c), words)), F.size(listed(cut(F.lower(c)), words)))


def word_format(c: Column) -> Column:
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}_]+", " ")), F.lit(" "))


#: Sentence ends: a stop, perhaps with closing marks, before white space; and line ends.
_STOP = r"(?<=[.!?…])\s+(?=[\p{Lu}\p{N}\"'«„“(])|\n+"


def sentences(c: Column) -> Column:
    """Sentences of a text, trimmed, empty ones left out. Scripts with a full stop of their own
    (Ethiopic, Burmese, Devanagari, Ol Chiki, Khmer, Tibetan, Han) are split after it."""
    own = F.regexp_replace(c, r"([።፧၊။।॥᱾᱿។༎。！？])\s*", "$1\n")
    return F.filter(F.transform(F.split(own, _STOP), F.trim), lambda s: s != "")


def word_values(tokens: Column, values: Column, how: str = "sum") -> Column:
    """Sum or mean of the values of the sub-words of each word, in order."""
    n = merge_subwords(tokens)

    def pooled(x: Column) -> Column:
        of = lambda k: F.transform(F.filter(F.arrays_zip(x["n"].alias("n"), x["v"].alias("v")), lambda e: e["n"] == k), lambda e: e["v"])
        total = lambda a: F.aggregate(a, F.lit(0.0), lambda s, y: s + y)
        one = (lambda a: total(a)) if how == "sum" else (lambda a: total(a) / F.size(a))
        return F.transform(F.sequence(F.lit(0), F.array_max(x["n"])), lambda k: let(of(k), one))

    none = F.expr("array()").cast("array<double>")
    return F.when(F.size(tokens) > 0, let(F.struct(n.alias("n"), values.cast("array<double>").alias("v")), pooled)).when(tokens.isNotNull(), none)


def merge_subwords(tokens: Column) -> Column:
    """Word number (from 0) of each sub-word: one begins at the first token, at ▁, __ and <."""
    starts = F.transform(tokens, lambda t, i: ((i == 0) | t.startswith("▁") | t.startswith("__") | t.startswith("<")).cast("int"))
    return let(starts, lambda s: F.transform(s, lambda _, i: F.aggregate(F.slice(s, F.lit(1), i + 1), F.lit(0), lambda a, x: a + x) - 1))


def parse_alignment(c: Column, reverse: bool = False, one_indexed: bool = False, one_add: bool = False) -> Column:
    """array<struct<tgt,src>> of "3-2 5p4"; p marks possible links and reads like -."""
    shift = int(one_add) - int(one_indexed)

    def pair(x: Column) -> Column:
        s = F.split(F.replace(x, F.lit("p"), F.lit("-")), "-")
        a, b = F.get(s, 0).cast("int") + shift, F.get(s, 1).cast("int") + shift
        return F.struct((b if reverse else a).alias("tgt"), (a if reverse else b).alias("src"))

    return F.transform(F.filter(F.split(F.trim(c), r"\s+"), lambda x: x != ""), pair)


def nfkc(by: str = "NFKC"):
    """Unicode normal form as an Arrow UDF; Spark has no built-in one."""
    def run(s):
        return s.map(lambda x: unicodedata.normalize(by, x) if x is not None else None)

    return F.pandas_udf(run, "string", F.PandasUDFType.SCALAR)

