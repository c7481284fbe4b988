"""Merkle fingerprints of texts: sentences, paragraphs, sections, root.

Built from DataFrame functions only.  A paragraph is a line; its leaves are its sentences.  A
sentence of more than LONG characters is cut further, at a space behind one of the letters of
BORDER after SHORT characters, so that borders move with the text, and after LONG at the
latest.  Leaves put together are the line, so equal roots mean equal texts.  A node is the
SHA-256 of its children's digests in order.  A section ends at a paragraph whose digest starts
with 0-3, so an insertion moves no later section border.  The fingerprint is the root's
digest, then the tree with digests of CODE digits:

    root:section=paragraph-leaf.leaf,paragraph-leaf;section=paragraph-leaf
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .neighbours import with_next

CODE = 12  # hex digits of a shortened digest
SHORT, LONG = 48, 192
BORDER = "deknst0-4"
SENTENCE_END = r"(?<=[.!?] )|(?<=[。！？])"
CUT = rf"(?s).{{{SHORT},{LONG}}}?(?:(?<=[{BORDER}]) |\z)|.{{1,{LONG}}}"


def _digest(joined: Column) -> Column:
    return F.sha2(joined, 256)


def _short(digest: Column) -> Column:
    return F.substring(digest, 1, CODE)


def _paragraph(line: Column) -> Column:
    """struct(digest, shown) of one line."""
    sentences = F.filter(F.split(line, SENTENCE_END), lambda s: s != "")
    parts = F.when(line == "", F.array(F.lit(""))).otherwise(F.flatten(F.transform(
        sentences, lambda s: F.when(F.char_length(s) > LONG, F.regexp_extract_all(
            s, F.lit(CUT), 0)).otherwise(F.array(s)))))
    leaves = F.transform(parts, lambda s: _digest(s))
    node = F.transform(F.array(leaves), lambda ds: F.struct(
        _digest(F.concat_ws("", ds)).alias("d"),
        F.concat_ws(".", F.transform(ds, _short)).alias("shown")))
    return F.element_at(node, 1)


def _with(value: Column, use) -> Column:
    """use(value) with the value computed once, however often lambdas read it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _sections(paragraphs: Column) -> Column:
    """array<array<struct>>: paragraphs up to and with each border, cut out by position."""
    def cut(ps: Column) -> Column:
        last = F.size(ps)
        ends = F.filter(F.transform(ps, lambda p, i: F.when(
            (F.substring(p["d"], 1, 1) < "4") | (i + 1 == last), i + 1)), lambda e: e.isNotNull())
        return _with(ends, lambda es: F.transform(es, lambda e, i: _after(ps, es, e, i)))

    def _after(ps: Column, es: Column, end: Column, i: Column) -> Column:
        start = F.when(i == 0, 0).otherwise(F.get(es, i - 1))
        return F.slice(ps, start + 1, end - start)

    return _with(paragraphs, cut)


def _node(children: Column) -> Column:
    digest = _digest(F.concat_ws("", F.transform(children, lambda p: p["d"])))
    shown = F.concat_ws(",", F.transform(
        children, lambda p: F.concat(_short(p["d"]), F.lit("-"), p["shown"])))
    return F.struct(digest.alias("d"), shown.alias("shown"))


def fingerprint(text: Column) -> Column:
    """Null texts count as empty, so they equal an empty text."""
    lines = F.transform(F.split(F.coalesce(text, F.lit("")), "\n"), _paragraph)
    sections = F.transform(_sections(lines), _node)
    whole = F.transform(F.array(sections), lambda s: F.concat(
        _digest(F.concat_ws("", F.transform(s, lambda x: x["d"]))), F.lit(":"),
        F.concat_ws(";", F.transform(
            s, lambda x: F.concat(_short(x["d"]), F.lit("="), x["shown"])))))
    return F.element_at(whole, 1)


def root(print_: Column) -> Column:
    return F.substring_index(print_, ":", 1)


def sections(print_: Column) -> Column:
    return F.split(F.substring_index(print_, ":", -1), ";")


def leaves(print_: Column) -> Column:
    """Shortened digests of the sentences."""
    return F.regexp_extract_all(print_, F.lit(f"[-.]([0-9a-f]{{{CODE}}})"), 1)


def differing_sections(a: Column, b: Column) -> Column:
    """Positions (from 0) of the sections of `a` that `b` does not hold; each is looked for
    among those of `b`."""
    theirs = F.transform(sections(b), lambda s: F.substring_index(s, "=", 1))
    return F.filter(
        F.transform(sections(a), lambda s, i: F.when(
            ~F.array_contains(theirs, F.substring_index(s, "=", 1)), i)),
        lambda i: i.isNotNull())


def likeness(a: Column, b: Column) -> Column:
    """Twice the shared sentences over the sentences of both, each counted once; 1 for equal
    roots and less than 1 for all others."""
    mine, theirs = F.array_distinct(leaves(a)), F.array_distinct(leaves(b))
    shared = F.size(F.array_intersect(mine, theirs))
    dice = 2.0 * shared / (F.size(mine) + F.size(theirs))
    return F.when(root(a) == root(b), 1.0).otherwise(F.least(dice, F.lit(0.999999)))


def edited(text: Column, other: Column) -> Column:
    """The last half of the code points replaced by as many of the other text's first."""
    n = F.char_length(text)
    half = F.floor(n / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), n - half), F.substring(other, F.lit(1), half))


def compare_neighbours(docs: DataFrame, id_col: str = "doc_id",
                       text_col: str = "text") -> DataFrame:
    """Fingerprint every text, its edit with the next document's start, and the likenesses.

    Defined cases: null texts are empty texts; an empty text equals its edit; null ids come
    first; repeated ids follow one another in the order of a hash of their texts; a lone
    document is its own next; an empty table gives no rows; other columns are ignored.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("t"))
    both = with_next(rows, F.col("doc_id"), F.xxhash64("t"), ["t", "fingerprint"],
                     derive=lambda df: df.withColumn("fingerprint", fingerprint(F.col("t"))))
    changed = both.withColumn("e", edited(F.col("t"), F.col("next_t"))) \
        .withColumn("edited_fingerprint", fingerprint(F.col("e")))
    return changed.select(
        "doc_id", F.char_length("t").cast("long").alias("n_chars"),
        F.sha2(F.col("e"), 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"))
