"""Text expressions. All of them stay inside the JVM."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def title_case(text: Column) -> Column:
    """Upper-case the first letter of every run of letters, lower-case the rest.

    ``initcap`` alone only looks at white space: ``O'NEIL`` would end as ``O'neil``.
    """
    runs = F.regexp_extract_all(text, F.lit(r"(\p{L}+|\P{L}+)"), F.lit(1))
    return F.array_join(F.transform(runs, F.initcap), "")


def digits_to_int(text: Column) -> Column:
    """``1998/I`` becomes 1998; nothing left, or too large a number, becomes null."""
    return F.regexp_replace(text, r"\D", "").try_cast("int")


def quoted_items(text: Column) -> Column:
    """All items between single quotes, as an array; empty if there is none."""
    return F.regexp_extract_all(text, F.lit("'(.*?)'"), F.lit(1))


def quoted_text(text: Column) -> Column:
    """Quoted items joined by a comma; null if there is none."""
    return F.nullif(F.array_join(quoted_items(text), ", "), F.lit(""))


def list_literal(text: Column) -> Column:
    """Parse a list literal with single or double quotes into an array."""
    return F.from_json(
        text,
        "array<string>",
        {"allowSingleQuotes": "true", "allowBackslashEscapingAnyCharacter": "true"},
    )


def speak(name: Column, utterance: Column) -> Column:
    """``name: utterance``; null if either side is null, which ``concat_ws`` would hide."""
    return F.concat(name, F.lit(": "), utterance)


def strip(text: Column) -> Column:
    """Trim all white space at both ends, line breaks included."""
    return F.btrim(text, F.lit(" \t\n\r\x0b\x0c"))


def same_text(first: Column, second: Column) -> Column:
    """Equal, whatever the case."""
    return F.lower(first) == F.lower(second)


def longest(first: Column, second: Column) -> Column:
    """The longer text; the first one on a tie."""
    return F.when(F.length(first) >= F.length(second), first).otherwise(second)


def present_names(people: Column) -> Column:
    """Names of an array of people, without null or empty ones."""
    named = F.filter(people, lambda p: p["name"].isNotNull() & (p["name"] != ""))
    return F.transform(named, lambda p: p["name"])


def item_at(items: Column, index: Column) -> Column:
    """Zero-based item; null for a null index or one past the end."""
    return F.when(index >= 0, F.get(items, index))


def field_or(df: DataFrame, name: str, default: object, on_null: str = "default") -> Column:
    """A column, or a default.

    The default replaces a column that the schema lacks. Nulls are replaced as well
    unless ``on_null`` is ``"keep"``.
    """
    if on_null not in ("keep", "default"):
        raise ValueError("on_null is 'keep' or 'default'")
    if name not in df.columns:
        return F.lit(default)
    return F.col(name) if on_null == "keep" else F.coalesce(F.col(name), F.lit(default))


def labelled_text(df: DataFrame, fields: Mapping[str, str], default: str = "Unknown") -> Column:
    """One ``Label: value`` line per field, for ``fields`` given as column to label."""
    lines = []
    for name, label in fields.items():
        value = F.col(name).cast("string") if name in df.columns else F.lit(None).cast("string")
        lines.append(F.concat(F.lit(f"{label}: "), F.coalesce(value, F.lit(default))))
    return F.concat_ws("\n", *lines)


def fill_template(template: Column, placeholder: str, value: Column) -> Column:
    return F.replace(template, F.lit("{" + placeholder + "}"), value)


def letter_tokens(text: Column) -> Column:
    """Lower-case runs of letters or digits of any script."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))


def rouge_tokens(text: Column, unicode: bool = False) -> Column:
    """Lower-case runs of ``a-z0-9``, or of all letters and digits."""
    if unicode:
        return letter_tokens(text)
    return F.regexp_extract_all(F.lower(text), F.lit("[a-z0-9]+"), F.lit(0))


# The replacement rules of the public "13a" scheme for BLEU, in order.
BLEU_RULES = (
    ("<skipped>", ""),
    ("-\n", ""),
    ("\n", " "),
    ("&quot;", '"'),
    ("&amp;", "&"),
    ("&lt;", "<"),
    ("&gt;", ">"),
)
BLEU_SPACING = (
    (r"([\{-\~\[-\`!-\&\(-\+\:-\@\/])", " $1 "),  # without the space, which splits anyway
    (r"([^0-9])([\.,])", "$1 $2 "),
    (r"([\.,])([^0-9])", " $1 $2"),
    (r"([0-9])(-)", "$1 $2 "),
)


def bleu_tokens(text: Column) -> Column:
    """Words and punctuation marks by the "13a" rules; case is kept."""
    for old, new in BLEU_RULES:
        text = F.replace(text, F.lit(old), F.lit(new))
    text = F.concat(F.lit(" "), text, F.lit(" "))
    for pattern, new in BLEU_SPACING:
        text = F.regexp_replace(text, pattern, new)
    return F.regexp_extract_all(text, F.lit(r"\S+"), F.lit(0))


def space_tokens(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(r"\S+"), F.lit(0))


def seeded_hash(seed: int, *keys: str | Column) -> Column:
    """The md5 text that stands for every random choice in this package."""
    return F.md5(F.concat_ws(":", *keys, F.lit(str(seed))))


def hash_number(digest: Column) -> Column:
    """The first 32 bits of an md5 text as a number."""
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")
