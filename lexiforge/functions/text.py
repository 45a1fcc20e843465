"""Text functions on columns; all but NFKC are built-in expressions."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .batches import ROWS
from .columns import let
from .taxonomy import FUNDING_KEYWORDS, GENERIC_PHRASES, IMPLEMENTATION_KEYWORDS

#: Tokens that a prompt may hold, and the tokens counted for a word.
SAFE_TOKENS = 3796
TOKENS_PER_100_WORDS = 135
#: Words under which a page is taken to need a browser.
JS_HEAVY_WORDS = 150
#: White space as str.split() has it.
SPACE = r"[\s\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"


@F.arrow_udf(StringType())
def nfkc(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """Unicode NFKC, for which there is no built-in expression; a few texts are Python strings at once."""
    for texts in batches:
        for at in range(0, len(texts), ROWS):
            own = texts.slice(at, ROWS).to_pylist()
            yield pa.array([x if x is None or x.isascii() else unicodedata.normalize("NFKC", x) for x in own], pa.string())


def squeeze(text: Column) -> Column:
    """White space runs as one space, none at the ends."""
    return F.trim(F.regexp_replace(text, SPACE + "+", " "))


def normalise_web(text: Column, unicode: bool = True) -> Column:
    """NFKC, then white space squeezed."""
    return squeeze(nfkc(text) if unicode else text)


def normalise_pdf(text: Column, unicode: bool = True) -> Column:
    """NFKC, then control and format characters dropped except line feed and tab, then white space squeezed."""
    text = F.coalesce(text, F.lit(""))
    return squeeze(F.regexp_replace(nfkc(text) if unicode else text, r"[\p{Cc}\p{Cf}&&[^\n\t]]", ""))


def words(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE + "+"), lambda w: w != "")


def word_count(text: Column) -> Column:
    return F.size(words(text))


def approx_tokens(text: Column) -> Column:
    """Whole part of 1.35 tokens a word, in integers."""
    return F.floor(word_count(text) * TOKENS_PER_100_WORDS / 100).cast("int")


def route(tokens: Column) -> Column:
    return F.when(tokens <= SAFE_TOKENS, "single_pass").otherwise("map_reduce")


def js_heavy(n_words: Column) -> Column:
    return n_words < JS_HEAVY_WORDS


def edge_trim(title: Column) -> Column:
    """Separators and white space off both ends of a title."""
    edge = "[" + r"\s»›«|·–—:\-" + "]+"
    return F.trim(F.regexp_replace(F.regexp_replace(title, "^" + edge, ""), edge + "$", ""))


def join_lines(lines: Column) -> Column:
    """Lines joined by a space; a word broken by a hyphen before a lower-case letter is mended."""
    kept = F.filter(F.transform(lines, lambda x: F.trim(F.regexp_replace(x, SPACE, " "))), lambda x: x != "")
    return squeeze(F.regexp_replace(F.regexp_replace(F.array_join(kept, "\n"), r"(?<=[A-Za-z])-\n(?=[a-z])", ""), "\n", " "))


def hyphen_repair(text: Column) -> Column:
    return F.regexp_replace(text, r"-\s+", "")


def is_bold_font(name: Column) -> Column:
    """Weights spelt out, or the abbreviations md, bd and blk as a part of the name."""
    low = F.lower(F.trim(F.coalesce(name, F.lit(""))))
    return low.rlike("bold|black|heavy|medium") | low.rlike(r"(?:^|[-_])(?:\d{2})?(?:md|bd|blk)(?:$|[-_])")


def heading_key(text: Column, unicode: bool = True) -> Column:
    """Key that equal headings share whatever their punctuation, dashes and dotted leaders."""
    s = F.trim(F.lower(normalise_pdf(text, unicode)))
    s = F.regexp_replace(s, r"\.{3,}\s*\d{1,4}\s*$", "")
    s = F.regexp_replace(s, "[–—-]", " ")
    return F.trim(F.regexp_replace(F.regexp_replace(s, r"[^\p{L}\p{N}_]+", " "), r"\s+", " "))


def heading_key_without_number(text: Column, unicode: bool = True) -> Column:
    return F.regexp_replace(heading_key(text, unicode), r"^\d{1,3}(?:\s+\d{1,3})*\s+", "")


def numeric_prefix(text: Column, unicode: bool = True) -> Column:
    """Leading decimal number of a heading without its last point; empty if none."""
    return F.regexp_extract(normalise_pdf(text, unicode), r"^(\d{1,3}(?:\.\d{1,3})*)\.?\s+", 1)


def numeric_depth(text: Column, unicode: bool = True) -> Column:
    """4. -> 1, 4.1 -> 2; null without a number."""
    found = F.regexp_extract(normalise_pdf(text, unicode), r"^(\d{1,3}(?:\.\d{1,3})*)\.?\s+\S", 1)
    return F.when(found != "", F.size(F.split(found, r"\.")))


def margin_signature(text: Column, unicode: bool = True) -> Column:
    """Running headers and footers with their page number masked."""
    s = F.lower(normalise_pdf(text, unicode))
    return F.regexp_replace(F.regexp_replace(s, r"^\d{1,4}\s+", "<page> "), r"\s+\d{1,4}$", " <page>")


def is_chunk_heading(line: Column) -> Column:
    """Markdown, all-capital or numbered line of at most 120 characters.

    An all-capital line of three letters counts; a number needs a point or a
    bracket right before the space.
    """
    s = F.trim(F.regexp_replace(line, r"^\s+|\s+$", ""))
    short = (s != "") & (F.length(s) <= 120)
    return short & (s.rlike(r"^#{1,6}\s+\S") | s.rlike(r"^[A-Z](?:[A-Z\s\d:\-]{3,}|[A-Z\s\d:\-]{2})$") | s.rlike(r"^\d+(?:\.\d+)*[.)]\s+\S"))


def is_linked_heading(line: Column) -> Column:
    """Numbered or all-capital line, as the flat reader of linked documents takes it."""
    s = F.trim(line)
    return (s != "") & (F.length(s) <= 120) & (s.rlike(r"^\d+(?:\.\d+)*\.?\s+[A-Z]") | s.rlike(r"^[A-Z][A-Z\s]{3,60}$"))


def paragraphs(text: Column) -> Column:
    """Parts between blank lines, trimmed, without empty ones."""
    cut = F.transform(F.split(text, r"\n\s*\n"), lambda p: F.regexp_replace(p, r"^\s+|\s+$", ""))
    return F.filter(cut, lambda p: p != "")


def sentences(text: Column) -> Column:
    """Parts between a full stop, question or exclamation mark and a capital."""
    cut = F.transform(F.split(text, r"(?<=[.!?])\s+(?=[A-Z])"), lambda p: F.regexp_replace(p, r"^\s+|\s+$", ""))
    return F.filter(cut, lambda p: p != "")


def lines(text: Column) -> Column:
    """Lines as str.splitlines() cuts them."""
    cut = F.split(text, r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029]")
    return let(cut, lambda c: F.when(F.element_at(c, -1) == "", F.slice(c, F.lit(1), F.size(c) - 1)).otherwise(c))


def part_label(title: Column, part: Column, total: Column, continued: Column) -> Column:
    """``[Section: T — Part 2 of 3, Paragraph continued]``; ``part`` counts from 1."""
    name = F.when(F.coalesce(title, F.lit("")) == "", "Preamble").otherwise(title)
    more = F.when(continued, ", Paragraph continued").otherwise("")
    long = F.concat(F.lit("[Section: "), name, F.lit(" — Part "), part.cast("string"), F.lit(" of "), total.cast("string"), more, F.lit("]"))
    return F.when(total == 1, F.concat(F.lit("[Section: "), name, F.lit("]"))).otherwise(long)


def holds_any(text: Column, phrases: list[str]) -> Column:
    low = F.lower(F.coalesce(text, F.lit("")))
    out = F.lit(False)
    for p in phrases:
        out = out | low.contains(p)
    return out


def is_generic(text: Column) -> Column:
    return holds_any(text, GENERIC_PHRASES)


def mentions_funding_process(text: Column) -> Column:
    return holds_any(text, FUNDING_KEYWORDS)


def mentions_implementation(text: Column) -> Column:
    return holds_any(text, IMPLEMENTATION_KEYWORDS)


def clean_key_point(point: Column) -> Column:
    """Leaked remarks about the source text taken out."""
    p = F.regexp_replace(point, r",?\s*though the exact [^,.]+ (?:is not|are not)[^.]*\.", ".")
    p = F.regexp_replace(p, r",?\s*though (?:this|it|the) (?:figure|number|percentage|statistic)[^.]*\.", ".")
    return F.regexp_replace(F.regexp_replace(p, r"(?i)\s*\(note:[^)]*\)", ""), r"^\s+|\s+$", "")


NOT_DESCRIBED = "Not described in the document."


def clean_not_described(text: Column) -> Column:
    """The fallback sentence alone, once, and only where fewer than three sentences say something."""
    t = F.regexp_replace(text, r"[Nn]ot described in the document (?:is|are)[^.]*\.", NOT_DESCRIBED)
    t = F.regexp_replace(t, r"(?i),\s*not described in the document\.", ". " + NOT_DESCRIBED)
    t = F.regexp_replace(t, r"^\s+|\s+$", "")
    cut = F.filter(F.transform(F.split(t, r"(?<=[.!?])\s+"), lambda s: F.trim(s)), lambda s: s != "")

    def settle(all_: Column) -> Column:
        real = F.filter(all_, lambda s: F.lower(s) != NOT_DESCRIBED.lower())
        missing = F.size(all_) - F.size(real)
        return (
            F.when(F.size(real) >= 3, F.array_join(real, " "))
            .when(missing > 1, F.array_join(F.concat(real, F.array(F.lit(NOT_DESCRIBED))), " "))
            .otherwise(F.array_join(all_, " "))
        )

    return F.trim(let(cut, settle))


def subsections(label: Column) -> Column:
    """Headings named in a merged label."""
    found = F.transform(F.regexp_extract_all(label, F.lit(r"##+ ([^|^\]]+)"), 1), lambda s: F.trim(s))
    return F.filter(found, lambda s: s != "")


def resolved(curated: Column, embedded: Column) -> Column:
    """The catalogue's value, else the file's, else empty."""
    return squeeze(F.coalesce(F.nullif(curated, F.lit("")), F.nullif(embedded, F.lit("")), F.lit("")))


def template_guidance(template: Column) -> Column:
    """(heading, questions) of a summary template: ``* `` lines are headings, the lines below them their questions."""
    lines_of = F.filter(F.transform(lines(template), lambda x: F.regexp_replace(x, r"^\s+|\s+$", "")), lambda x: x != "")

    def cut(own: Column) -> Column:
        starts = F.filter(F.transform(own, lambda x, i: F.when(x.startswith("* "), i)), lambda i: i.isNotNull())
        ends = F.concat(F.slice(starts, F.lit(2), F.size(starts)), F.array(F.size(own)))
        return F.transform(
            F.arrays_zip(starts.alias("lo"), ends.alias("hi")),
            lambda r: F.struct(
                F.regexp_replace(F.get(own, r["lo"]), r"^\*\s+", "").alias("heading"), F.slice(own, r["lo"] + 2, r["hi"] - r["lo"] - 1).alias("questions")
            ),
        )

    return let(lines_of, cut)


def guidance_block(template: Column) -> Column:
    """The guidance of a template as a prompt holds it."""
    parts = F.transform(
        template_guidance(template),
        lambda g: F.concat(F.lit('\n  "'), g["heading"], F.lit('"\n'), F.array_join(F.transform(g["questions"], lambda q: F.concat(F.lit("    → "), q, F.lit("\n"))), "")),
    )
    return F.array_join(parts, "")
