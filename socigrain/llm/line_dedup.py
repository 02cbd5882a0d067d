"""Near-duplicate lines by a deletion-neighbourhood join, in DataFrame functions only.

Lines are compared as word sequences; one edit is a word inserted, deleted or replaced.  Of lines
that are equal, the earliest (by document id, then line number) stays.  A line of ``NEAR_WORDS`` or
more words also goes if an earlier line of the corpus is one edit away; all lines are judged on the
input, so a line may go for an earlier one that goes itself.  Lines of fewer than ``LEAST_WORDS``
words always stay.

The neighbourhood: a line emits its variants with one word deleted as hashed keys, under
(variant, position) for replacements and under the variant alone for insertions and deletions,
where the undeleted lines take part too.  Equal keys meet in an aggregation that keeps the earliest
line of each role, so no pairs are listed however many lines share a key: within a replacement key
any two lines are one edit apart, and so are an undeleted line and any variant equal to it.
The partner found is then verified on the words themselves.

Only lines that can have a partner emit variants.  One edit leaves the first or the last
h = 4 * (n // 8) words of both lines untouched; lines whose two end keys occur with no other line
are left out, and of the others only positions outside the shared end are deleted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .common import cut, text_of

LEAST_WORDS, NEAR_WORDS = 5, 8
_SPACES = "[\\x20\\x09-\\x0D]+"


def _norm(line: Column) -> Column:
    """The line's words, joined by one space; most lines are so already, which plain look-ups tell."""
    other = line.startswith(" ") | line.endswith(" ") | line.contains("  ")
    for space in "\t\n\x0b\x0c\r":
        other = other | line.contains(space)
    return F.when(other, F.trim(F.regexp_replace(line, _SPACES, " "))).otherwise(line)


def _count(norm: Column) -> Column:
    """Number of words of a normalised line."""
    return F.when(norm == "", 0).otherwise(F.length(norm) - F.length(F.translate(norm, " ", "")) + 1)


def _first(norm: Column, n: Column) -> Column:
    return F.call_function("substring_index", norm, F.lit(" "), n)


def _last(norm: Column, n: Column) -> Column:
    return F.call_function("substring_index", norm, F.lit(" "), -n)


def _place() -> Column:
    """Order of lines in the corpus: null ids last, rows of one id by their text's fingerprint."""
    return F.struct(F.col("_doc").isNull().alias("n"), F.col("_doc").alias("d"), F.col("_print").alias("p"), F.col("_no").alias("l"))


def lines_of(rows: DataFrame) -> DataFrame:
    """(_doc, _print, _no, _norm, _n, _h, _g): numbered lines that are long enough, with a 128-bit name."""
    # normalised inside the array, so that what follows doesn't evaluate the pattern once per use
    normal = F.transform(F.split("_text", "\n", -1), _norm)
    lines = rows.select("_doc", "_print", F.posexplode(normal).alias("_no", "_norm")).withColumn("_n", _count(F.col("_norm")))
    return lines.filter(F.col("_n") >= LEAST_WORDS).select("*", F.xxhash64("_norm", F.lit(1)).alias("_h"), F.xxhash64("_norm", F.lit(2)).alias("_g"))


def _end_keys() -> dict[str, Column]:
    """Keys of a line's two ends; a line just over a step of h has those of the step below too."""
    n, norm, keys = F.col("_n"), F.col("_norm"), {}
    for step, length in enumerate((n, n - 1)):
        h = F.floor(length / 8).cast("int") * 4
        used = (n >= NEAR_WORDS) & (h > 0) & (F.lit(step == 0) | (n % 8 == 0))
        for side, part in enumerate((_first(norm, h), _last(norm, h))):
            keys[f"_k{step}{side}"] = F.when(used, F.xxhash64(part, h, F.lit(side)))
    return keys


def _variants(lines: DataFrame) -> DataFrame:
    """(_at, _v, _slot, _role): keys of the deletion neighbourhood of lines (_at, _norm, _head, _tail).

    _slot is the deleted position for replacements; under -1 undeleted lines (role 0) and variants
    (role 1) meet.  _head: another line shares the first words, so the edit lies behind them;
    _tail likewise.
    """
    n = _count(F.col("_norm"))
    end = F.floor((n - 1) / 8).cast("int") * 4
    positions = F.sequence(F.when(F.col("_tail"), 0).otherwise(end), F.when(F.col("_head"), n - 1).otherwise(n - end - 1))

    def variant(i: Column) -> Column:
        shorter = F.concat(_first(F.col("_norm"), i), F.lit(" "), _last(F.col("_norm"), F.col("_n") - i - 1))
        return F.struct(i.alias("i"), F.xxhash64(F.trim(shorter)).alias("v"))

    each = lines.select("_at", "_norm", n.alias("_n"), positions.alias("_positions"))
    deleted = each.select("_at", F.inline(F.transform("_positions", variant)))
    keys = F.array(F.struct(F.col("i").alias("slot"), F.lit(0).alias("role")), F.struct(F.lit(-1).alias("slot"), F.lit(1).alias("role")))
    deleted = deleted.select("_at", F.col("v").alias("_v"), F.inline(keys)).select("_at", "_v", F.col("slot").alias("_slot"), F.col("role").alias("_role"))
    return deleted.unionByName(lines.select("_at", F.xxhash64("_norm").alias("_v"), F.lit(-1).alias("_slot"), F.lit(0).alias("_role")))


def _one_edit(a: Column, b: Column) -> Column:
    """Whether two different word arrays are one edit apart: what ends have in common leaves one word."""

    def common(x, y):
        same = F.zip_with(x, y, lambda p, q: F.coalesce(p == q, F.lit(False)))
        first = F.array_position(same, False)
        return F.when(first == 0, F.size(same)).otherwise(first - 1)

    longest = F.greatest(F.size(a), F.size(b))
    return (F.abs(F.size(a) - F.size(b)) <= 1) & (common(a, b) + common(F.reverse(a), F.reverse(b)) >= longest - 1)


def near_lines(rows: DataFrame, distinct: DataFrame) -> DataFrame:
    """(_at, _near): first places of lines with an earlier line one edit away.

    ``rows``: keyed texts; ``distinct``: (_h, _at, end keys), one row per different line.
    """
    each = F.array(*[F.struct(F.col(k).alias("key"), F.lit(k.endswith("0")).alias("head")) for k in _end_keys()])
    ends = distinct.select("_h", F.inline(each)).filter("key IS NOT NULL")
    shared = ends.groupBy("key").agg(F.count(F.lit(1)).alias("_times")).filter("_times > 1").select("key")
    able = ends.join(shared, "key").groupBy("_h").agg(F.max("head").alias("_head"), F.max(~F.col("head")).alias("_tail"))
    # the words of these lines only, taken from the documents in which they come first
    placed = distinct.select("_h", "_at").join(able, "_h")
    wanted = placed.groupBy(F.col("_at.d").alias("_d"), F.col("_at.p").alias("_p")).agg(F.collect_list(F.struct("_at", "_head", "_tail")).alias("_able"))
    found = rows.join(wanted, F.col("_doc").eqNullSafe(F.col("_d")) & (F.col("_print") == F.col("_p")))
    texts = found.select(F.split("_text", "\n", -1).alias("_all"), F.inline("_able"))
    lines = texts.select("_at", "_head", "_tail", _norm(F.element_at("_all", F.col("_at.l") + 1)).alias("_norm"))
    lines = lines.dropDuplicates(["_at"])  # one shuffle that all uses below share, as they share that of the texts
    emitted = _variants(lines)
    met = emitted.groupBy("_v", "_slot").agg(
        F.min(F.when(F.col("_role") == 0, F.col("_at"))).alias("_m0"), F.max(F.when(F.col("_role") == 0, F.col("_at"))).alias("_x0"),
        F.min(F.when(F.col("_role") == 1, F.col("_at"))).alias("_m1"),
    ).filter("(_slot >= 0 AND _x0 > _m0) OR (_slot < 0 AND _m0 IS NOT NULL AND _m1 IS NOT NULL)").drop("_x0")
    partner = F.when((F.col("_slot") >= 0) | (F.col("_role") == 1), F.col("_m0")).otherwise(F.col("_m1"))
    pairs = emitted.join(met, ["_v", "_slot"]).select("_at", partner.alias("_to")).filter("_to < _at").distinct()
    words = lines.select("_at", F.split("_norm", " ").alias("_words"))
    checked = pairs.join(words, "_at").join(words.withColumnsRenamed({"_at": "_to", "_words": "_other"}), "_to")
    return checked.filter(_one_edit(F.col("_words"), F.col("_other"))).select("_at").distinct().withColumn("_near", F.lit(True))


def marked(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(_row, _doc, _print, _text, _had, _gone): every row of ``docs`` with the numbers of the lines to remove, or null.

    _row holds the columns but the text, _had whether there was one.  Rows that repeat both id and
    text count as one document: their lines are at the same places.  Null and empty texts have no
    lines to remove; null ids come last; an empty table stays empty.
    """
    others = [F.col(f"`{c}`") for c in docs.columns if c != text]
    rows = docs.select(
        F.struct(*others, F.lit(0).alias("_")).alias("_row"), F.col(doc_id).alias("_doc"), F.xxhash64(text_of(text)).alias("_print"),
        text_of(text).alias("_text"), F.col(text).isNotNull().alias("_had"),
    )
    bare = rows.select("_doc", "_print", "_text")
    lines = lines_of(bare)
    keys = _end_keys()
    first = lines.select("_h", "_g", _place().alias("_at"), *[c.alias(k) for k, c in keys.items()])
    distinct = cut(
        first.groupBy("_h", "_g").agg(F.min("_at").alias("_at"), *[F.min(k).alias(k) for k in keys], F.count(F.lit(1)).alias("_times")), "lines"
    )
    near = near_lines(bare, distinct)
    # lines that occur once and have no partner need no look at their places
    known = distinct.select("_h", "_g", "_at", "_times").join(near, "_at", "left")
    suspect = known.filter("_times > 1 OR _near").select("_h", "_g", F.col("_at").alias("_first"), F.coalesce("_near", F.lit(False)).alias("_near"))
    gone = lines.select("_doc", "_print", "_no", "_h", "_g").join(suspect, ["_h", "_g"]).filter(F.col("_near") | (_place() != F.col("_first")))
    gone = gone.groupBy(F.col("_doc").alias("_d"), F.col("_print").alias("_p")).agg(F.collect_set("_no").alias("_gone"))
    return rows.join(gone, F.col("_doc").eqNullSafe(F.col("_d")) & (F.col("_print") == F.col("_p")), "left").drop("_d", "_p")


def kept_text() -> Column:
    """The text without the lines in _gone, other lines unchanged."""
    lines = F.split("_text", "\n", -1)
    kept = F.filter(F.transform(lines, lambda x, i: F.when(~F.array_contains("_gone", i), x)), lambda x: x.isNotNull())
    return F.when(F.col("_gone").isNull(), F.col("_text")).otherwise(F.array_join(kept, "\n"))


def remove_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_lines, n_removed, kept) of every row."""
    return marked(docs, doc_id, text).select(
        F.col("_doc").alias("doc_id"),
        F.size(F.split("_text", "\n", -1)).cast("long").alias("n_lines"),
        F.coalesce(F.size("_gone"), F.lit(0)).cast("long").alias("n_removed"),
        kept_text().alias("kept"),
    )


def rewrite(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", n_chars: str | None = "n_chars") -> DataFrame:
    """``docs`` with the repeated lines gone from ``text`` and ``n_chars`` counted anew where there is one."""
    out = marked(docs, doc_id, text).select("_row.*", F.when(F.col("_had"), kept_text()).alias("_kept"))
    columns = []
    for name in docs.columns:
        if name == text:
            columns.append(F.col("_kept").alias(name))
        elif name == n_chars:
            columns.append(F.when(F.col("_kept").isNotNull(), F.length("_kept")).cast(docs.schema[name].dataType).alias(name))
        else:
            columns.append(F.col(f"`{name}`"))
    return out.select(*columns)


def digests(docs: DataFrame) -> DataFrame:
    """(doc_id, n_lines, n_removed, kept_sha256)."""
    return remove_lines(docs).selectExpr("doc_id", "n_lines", "n_removed", "sha2(kept, 256) AS kept_sha256")
