"""Column functions over names, paths and page texts. All are built-in expressions; none needs a Python worker."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# fixed values: the URL namespace of version-5 identifiers, the page delimiter, the filename pattern, Unicode classes
URL_NAMESPACE = "6ba7b8119dad11d180b400c04fd430c8"
FILENAME = r"(?iU)\A【(\d{4})-(\d{2})】([\s\S]+)\.pdf\z"
SPACE = r"[\p{IsWhite_Space}\x1c-\x1f]"
CLASSES = {
    "replacement_char_count": r"\x{FFFD}",
    "private_use_char_count": r"[\x{E000}-\x{F8FF}\x{F0000}-\x{FFFFD}\x{100000}-\x{10FFFD}]",
    "control_char_count": r"[\p{Cc}&&[^\t\n\r]]",
    "ascii_letter_count": r"[A-Za-z]",
    "cjk_char_count": r"[\x{3400}-\x{4DBF}\x{4E00}-\x{9FFF}\x{F900}-\x{FAFF}\x{20000}-\x{323AF}]",
    "digit_count": r"\p{Nd}",
    "whitespace_count": SPACE,
}
#: what does not print: all but the printable characters and the space
UNPRINTABLE = r"[[\p{C}\p{Z}]&&[^\x20]]"
SUSPICIOUS = ("replacement_char_count", "private_use_char_count", "control_char_count")
SENTENCE_ENDS = r"[。！？!?；;.!]+"



def uuid5(name: Column, namespace: str = URL_NAMESPACE) -> Column:
    """Version-5 identifier of a name: SHA-1 of namespace and name, with the version and variant bits set."""
    h = F.sha1(F.concat(F.unhex(F.lit(namespace)), F.encode(name, "UTF-8")))
    digit = F.conv(F.substring(h, 17, 1), 16, 10).cast("int")
    fourth = F.concat(F.element_at(F.array(*map(F.lit, "89ab")), digit % 4 + 1), F.substring(h, 18, 3))
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.concat(F.lit("5"), F.substring(h, 14, 3)), fourth, F.substring(h, 21, 12))


def file_instance_id(root: Column, path: Column, scheme: str = "corpus") -> Column:
    """Identity of a file by root and relative path, not by content; null for an absolute or empty path."""
    name = F.concat(F.lit(f"{scheme}://file-instance/"), root, F.lit("/"), path)
    return F.when((path != "") & ~path.startswith("/"), uuid5(name))


def calibration_item_id(sample_id: Column, file_id: Column, scheme: str = "corpus") -> Column:
    return uuid5(F.concat(F.lit(f"{scheme}://calibration-item/"), sample_id, F.lit("/"), file_id))


def parent_group(path: Column) -> Column:
    parts = F.split(path, "/")
    return F.when(F.size(parts) > 1, parts[0]).otherwise("")


def base_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def extension(name: Column) -> Column:
    """With its dot and in its own case; none for names that only begin with a dot."""
    return F.regexp_extract(name, r"(?s)^.+(\.[^.]+)$", 1)


def filename_part(name: Column, group: int) -> Column:
    """Year (1), issue (2) or title (3) of a name that matches the whole pattern, else null."""
    return F.when(name.rlike(FILENAME), F.regexp_extract(name, FILENAME, group))


def filename_status(name: Column) -> Column:
    return F.when(name.isNull(), "error").when(name.rlike(FILENAME), "matched").otherwise("unmatched")


def stripped(text: Column) -> Column:
    """Without Unicode white space at either end."""
    return F.regexp_replace(text, rf"\A{SPACE}+|{SPACE}+\z", "")


def newlines(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))


def probe_pages(pages: Column) -> Column:
    """First, middle and last page (from 0), in that order, without repeats; none of no pages."""
    n = pages.cast("int")
    return F.when(n > 0, F.array_distinct(F.array(F.lit(0), F.floor(n / 2).cast("int"), n - 1))).otherwise(F.array().cast("array<int>"))


def ocr_pages(pages: Column) -> Column:
    """The first three pages and those at half and three quarters, sorted, without repeats."""
    n = pages.cast("int")
    at = F.array(F.lit(0), F.lit(1), F.lit(2), F.floor((n - 1) * 0.5).cast("int"), F.floor((n - 1) * 0.75).cast("int"))
    return F.array_sort(F.array_distinct(F.filter(at, lambda p: (p >= 0) & (p < n))))


def pages_of(text: Column, numbers: Column, size: int) -> Column:
    """Texts of the numbered pages, of `size` characters each."""
    return F.transform(numbers, lambda k: F.substring(text, k * size + 1, F.lit(size)))


def text_layer_status(counts: Column, failures: Column, threshold: int) -> Column:
    some = F.size(counts) > 0
    failed = failures > 0
    return (
        F.when(failed & ~some, "check_failed")
        .when(~failed & some & F.forall(counts, lambda c: c == 0), "text_absent")
        .when(~failed & some & F.forall(counts, lambda c: c >= threshold), "text_present")
        .otherwise("mixed_or_uncertain")
    )


def assembled(pages: Column, numbers: Column) -> Column:
    """Page texts with their delimiters, joined by line feeds."""
    part = F.zip_with(numbers, pages, lambda k, t: F.concat(F.lit("<<<PAGE:"), k.cast("string"), F.lit(">>>\n"), t))
    return F.array_join(part, "\n")


def total_length(texts: Column) -> Column:
    return F.aggregate(texts, F.lit(0), lambda n, t: n + F.length(t))


def sentence_count(text: Column) -> Column:
    return F.greatest(F.lit(1), F.size(F.filter(F.split(text, SENTENCE_ENDS), lambda s: stripped(s) != "")))


def safe_ratio(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a, b), F.lit(0.0))


#: the sixteen signals of a text, in order
SIGNAL_NAMES = (
    "total_chars", "replacement_char_count", "replacement_char_rate", "private_use_char_count", "private_use_char_rate", "control_char_count", "control_char_rate",
    "printable_char_count", "printable_char_ratio", "ascii_letter_count", "cjk_char_count", "digit_count", "whitespace_count", "whitespace_ratio", "suspicious_char_count", "suspicious_char_rate",
)


def bound(value: Column, use) -> Column:
    """use(value), with the value computed once."""
    return F.transform(F.array(value), use)[0]


def without_class(text: Column, pattern: str) -> Column:
    """The text without the characters of a class; runs go at once, and no group is repeated."""
    return F.regexp_replace(text, F.lit(f"{pattern}++"), F.lit(""))


def quality_signals(text: Column) -> Column:
    """A struct of the sixteen Unicode signals of a text: all null for a null text, all rates 0 for an empty one.

    Each class is counted once, as what its removal takes away. ASCII letters, most of a text, go first: no other class
    has any, so the others are counted in what is left, and those that share nothing with white space without it.
    """
    names = {n: n.removesuffix("_count") for n in CLASSES}
    lost = lambda t, name: F.length(t) - F.length(without_class(t, CLASSES[f"{name}_count"]))

    def counted(rest: Column) -> Column:
        unprintable = F.length(rest) - F.length(without_class(rest, UNPRINTABLE))
        inner = bound(without_class(rest, SPACE), lambda t: F.struct(F.length(t).alias("n"), *(lost(t, n).alias(n) for n in ("replacement_char", "private_use_char", "cjk_char", "digit"))))
        return bound(inner, lambda c: F.struct(F.length(text).alias("total"), *(c[n].alias(f"{n}_count") for n in ("replacement_char", "private_use_char", "cjk_char", "digit")), lost(rest, "control_char").alias("control_char_count"), (F.length(rest) - c["n"]).alias("whitespace_count"), (F.length(text) - F.length(rest)).alias("ascii_letter_count"), (F.length(text) - unprintable).alias("printable_char_count")))

    def signals(c: Column) -> Column:
        suspicious = sum((c[n] for n in SUSPICIOUS[1:]), c[SUSPICIOUS[0]])
        rate = lambda n: F.when(c["total"].isNotNull(), safe_ratio(n, c["total"]))
        named = {n: c[n] for n in (*names, "printable_char_count")} | {"total_chars": c["total"], "suspicious_char_count": suspicious, "suspicious_char_rate": rate(suspicious), "printable_char_ratio": rate(c["printable_char_count"]), "whitespace_ratio": rate(c["whitespace_count"])}
        named |= {f"{names[n]}_rate": rate(c[n]) for n in SUSPICIOUS}
        return F.struct(*(named[n].alias(n) for n in SIGNAL_NAMES))

    return bound(bound(without_class(text, CLASSES["ascii_letter_count"]), counted), signals)


def safe_relative_path(path: Column) -> Column:
    """Whether a path is relative and has no empty, '.' or '..' part."""
    return ~path.startswith("/") & F.forall(F.split(path, "/"), lambda p: ~p.isin("", ".", ".."))
