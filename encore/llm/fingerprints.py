"""Document fingerprints by invertible Bloom lookup sketches, with DataFrame functions only.

A text is the set of digests of its paragraphs: lines, long ones in runs of words, and finer runs of its opening, so that short
texts have several. A sketch has three rows of cells; a digest is counted in one cell of each row, which holds the number of its
digests and the exclusive or of them and of their checks. Its fingerprint is a small sketch. To compare two versions, sketches
as wide as their numbers of paragraphs are subtracted cell by cell, which leaves what differs; a cell with one digest left names it, and
taking that out of its other cells uncovers more. Cells are rows, so peeling is a chain of aggregations by cell that never leave the
partition of their document, of which there are as many as the number of paragraphs asks for. Where cells stay, the documents are
compared again with wider sketches.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import checkpointed

#: Words of a run at most, those of a run of the opening, letters of the opening, and letters of a word; longer ones are cut.
WORDS, OPENING_WORDS, OPENING, LETTERS = 64, 4, 160, 24


def runs(words: int) -> str:
    """Pattern of a run of words of one line."""
    return rf"(?:\S{{1,{LETTERS}}}+[^\S\n]+){{0,{words - 1}}}\S{{1,{LETTERS}}}"


#: Rows of a sketch, cells in a row of a fingerprint, and of the first sketch compared at least; each retry is ``WIDER`` times as wide.
ROWS, BASE, LEAST, WIDER = 3, 2, 16, 4
#: Rounds of peeling before the next wider sketch is tried; each looks at one row of cells in turn.
ROUNDS = 12
#: Digests of one task, about; each has a cell in every row.
DIGESTS_PER_TASK = 100_000


def digests(text: Column) -> Column:
    """Distinct 64-bit digests of a text's paragraphs; none of a null or blank text."""
    text = F.coalesce(text, F.lit(""))
    opening = F.regexp_extract_all(F.left(text, F.lit(OPENING)), F.lit(runs(OPENING_WORDS)), F.lit(0))
    found = F.concat(opening, F.regexp_extract_all(text, F.lit(runs(WORDS)), F.lit(0)))
    return F.array_distinct(F.transform(found, lambda p: F.xxhash64(p)))


def place(digest: Column, row: int | Column, width: int | Column) -> Column:
    """The cell of a digest in a row of a sketch; widths are powers of two."""
    width = F.lit(width) if isinstance(width, int) else width
    return F.xxhash64(digest, width, F.lit(row) if isinstance(row, int) else row).bitwiseAND(width.cast("long") - 1)


def check(digest: Column) -> Column:
    return F.xxhash64(digest, F.lit(-1))


def sketch(values: Column, width: int = BASE) -> Column:
    """The cells (n, key, check) of an array of digests, row by row."""
    nothing = F.struct(F.lit(0).alias("n"), F.lit(0).cast("long").alias("key"), F.lit(0).cast("long").alias("check"))

    def row(r: int) -> Column:
        marks = F.transform(values, lambda d: F.struct(d.alias("key"), check(d).alias("check"), place(d, r, width).alias("at")))

        def cell(marks: Column, at: Column) -> Column:
            def add(c: Column, m: Column) -> Column:
                return F.when(m["at"] == at, F.struct(
                    (c["n"] + 1).alias("n"), c["key"].bitwiseXOR(m["key"]).alias("key"), c["check"].bitwiseXOR(m["check"]).alias("check"))).otherwise(c)

            return F.aggregate(marks, nothing, add)

        # the marks are made once for all cells: an array of one element binds them
        return F.transform(F.array(marks), lambda m: F.transform(F.sequence(F.lit(0), F.lit(width - 1)), lambda at: cell(m, at)))[0]

    return F.concat(*map(row, range(ROWS)))


def written(cells: Column) -> Column:
    """A sketch as text: number, digests and half the checks of each cell in hex."""
    one = lambda c: F.concat_ws(".", F.hex(c["n"]), F.hex(c["key"]), F.hex(c["check"].bitwiseAND(F.lit((1 << 32) - 1))))
    return F.array_join(F.transform(cells, one), "/")


#: The row number of a digest that has been recovered.
FOUND = ROWS


def subtracted(rows: DataFrame, keys: Sequence[str], left: str, others: Sequence[str], attempt: int = 0) -> DataFrame:
    """Cells (keys, pair, width, row, at, n, key, check) of the sketch of ``left`` minus that of each other array, empty ones left out."""
    def width(other: str) -> Column:
        both = F.greatest(F.size(left) + F.size(other), F.lit(LEAST))
        return (F.pow(F.lit(2.0), F.ceil(F.log2(both))) * WIDER ** attempt).cast("int")

    def side(i: int, name: str, sign: int) -> Column:
        return F.transform(name, lambda d: F.struct(
            F.lit(i).alias("pair"), F.col(f"_width{i}").alias("width"), F.lit(sign).alias("n"), d.alias("key")))

    sized = rows.select(*keys, left, *others, *[width(o).alias(f"_width{i}") for i, o in enumerate(others)])
    both = F.concat(*[side(i, name, sign) for i, o in enumerate(others) for name, sign in ((left, 1), (o, -1))])
    each = sized.select(*keys, F.explode(both).alias("d")).select(*keys, "d.*", check(F.col("d.key")).alias("check"))
    cells = each.select(*each.columns, F.explode(F.array(*map(F.lit, range(ROWS)))).alias("row"))
    placed = cells.select(*keys, "pair", "width", "row", place(F.col("key"), F.col("row"), F.col("width")).alias("at"), "n", "key", "check")
    return added_up(placed, keys)


def added_up(cells: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row a cell; the empty ones are left out."""
    summed = cells.groupBy(*keys, "pair", "width", "row", "at").agg(
        F.sum("n").cast("int").alias("n"), F.bit_xor("key").alias("key"), F.bit_xor("check").alias("check"))
    return summed.where("n <> 0 OR key <> 0 OR check <> 0")


def peeled(cells: DataFrame, keys: Sequence[str], row: int) -> DataFrame:
    """Cells after taking out the digests that are alone in a cell of a row; a digest has one cell in it, so none is taken twice."""
    pure = (F.col("row") == row) & (F.abs("n") == 1) & (F.col("check") == check(F.col("key")))

    def change(to: int, at: Column, n: Column) -> Column:
        return F.struct(F.lit(to).alias("row"), at.alias("at"), n.alias("n"))

    taken = [change(FOUND, F.col("key"), F.col("n"))] + [
        change(r, place(F.col("key"), r, F.col("width")), -F.col("n")) for r in range(ROWS) if r != row]
    stays = F.struct(F.col("row"), F.col("at"), F.col("n"))
    changes = F.when(pure, F.array(*taken)).otherwise(F.array(stays))
    return added_up(cells.select(*keys, "pair", "width", F.explode(changes).alias("c"), "key", "check").select(
        *keys, "pair", "width", "c.*", "key", "check"), keys)


def differences(rows: DataFrame, keys: Sequence[str], left: str, others: Sequence[str], attempt: int = 0, lists: bool = True) -> DataFrame:
    """Keys and for each array of digests in ``others`` a struct (n_removed, n_added, failed; with ``lists`` removed and added) against ``left``.

    ``keys`` are unique and not null, arrays hold distinct digests and are not null. Nothing is shuffled if the rows are partitioned by some of the keys. What is recovered is
    exact: ``failed`` says that some cells of a sketch could not be emptied, and asks for another ``attempt``. Rows without any difference are left out.
    """
    cells = subtracted(rows, keys, left, others, attempt)
    for i in range(ROUNDS):
        cells = peeled(cells, keys, i % ROWS)

    def of(i: int) -> Column:
        found, here = F.col("row") == FOUND, F.col("pair") == i
        counts = [F.count_if(here & found & (F.col("n") == sign)).alias(name) for name, sign in (("n_removed", 1), ("n_added", -1))]
        digests_of = [F.collect_list(F.when(here & found & (F.col("n") == sign), F.col("key"))).alias(name)
                      for name, sign in (("removed", 1), ("added", -1))]
        failed = F.count_if(here & ~found) > 0
        return F.struct(*counts, failed.alias("failed"), *(digests_of if lists else [])).alias(others[i])

    return cells.groupBy(*keys).agg(*[of(i) for i in range(len(others))])


KEYS = ["known", "id", "hash"]


def keyed(documents: DataFrame, id: str, text: str) -> DataFrame:
    """(known, id, hash, text): documents by id (unknown ids first) and digest of the text."""
    text = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    own = F.col(f"`{id}`").cast("long")
    return documents.select(own.isNotNull().alias("known"), F.coalesce(own, F.lit(0)).alias("id"), F.xxhash64(text).alias("hash"), text.alias("text"))


def successors(rows: DataFrame) -> DataFrame:
    """(keys, n_chars, times, next): distinct keyed documents and the keys of the one after each; the first follows the last.

    The keys are sorted over the cluster; a row's successor is in its range, or the first of the next one.
    """
    counted = rows.groupBy(*KEYS).agg(F.count("*").alias("times"), F.max(F.char_length("text")).cast("long").alias("n_chars"))
    ranges = counted.repartitionByRange(*KEYS).select("*", F.spark_partition_id().alias("range"))
    ranges = checkpointed(ranges)  # ranges are those of this run
    key = F.struct(*KEYS)
    starts = ranges.groupBy("range").agg(F.min(key).alias("start"))
    in_order = Window.orderBy("range")  # one row a range
    first = F.first("start").over(in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    following = starts.select("range", F.coalesce(F.lead("start").over(in_order), first).alias("following"))
    inside = ranges.select("*", F.lead(key).over(Window.partitionBy("range").orderBy(*KEYS)).alias("next"))
    return inside.join(following, "range").select(*KEYS, "times", "n_chars", F.coalesce("next", "following").alias("next"))


def versions(texts: DataFrame, after: DataFrame) -> DataFrame:
    """(keys, times, n_chars, mine, edited, next, edited_sha256) of the documents in ``after``: digests of the text, of the edited one and
    of the following text. Of the following text only what the edit needs and the digests are shuffled."""
    own = texts.join(after.select(*KEYS, "times", "n_chars"), KEYS)
    half = F.floor(F.col("n_chars") / 2).cast("int")
    previous = after.select(*[F.col(f"next.{k}").alias(k) for k in KEYS], F.struct(*KEYS).alias("previous"), half.alias("wanted"))
    heads = texts.join(previous, KEYS).select(
        *[F.col(f"previous.{k}").alias(k) for k in KEYS], F.expr("left(text, wanted)").alias("head"), digests(F.col("text")).alias("next"))
    kept = F.expr("left(text, cast(n_chars - floor(n_chars / 2) as int))")
    both = own.select(*KEYS, "times", "n_chars", digests(F.col("text")).alias("mine"), kept.alias("kept")).join(heads, KEYS)
    return both.select(*KEYS, "times", "n_chars", "mine", "next", F.concat("kept", "head").alias("text")).select(
        *KEYS, "times", "n_chars", "mine", "next", F.sha2("text", 256).alias("edited_sha256"), digests(F.col("text")).alias("edited"))


PAIRS = ["edited", "next"]


def solved(each: DataFrame, keys: Sequence[str], left: str, others: Sequence[str], lists: bool = True, attempt: int = 0) -> DataFrame:
    """``differences`` of a written table without a failed one: those are found again, with wider sketches.

    Digests are dealt to tasks by their number, so that cells fit in memory whatever the partitions of the texts were.
    """
    sizes = each.select(F.sum(F.size(left) * len(others) + sum((F.size(o) for o in others), F.lit(0))).alias("n")).first()
    dealt = each.select(*keys, left, *others).repartition(1 + (sizes.n or 0) // DIGESTS_PER_TASK, *keys)
    found = checkpointed(differences(dealt, keys, left, others, attempt, lists))
    failed = F.lit(False)
    for o in others:
        failed = failed | F.col(f"{o}.failed")
    again = found.where(failed).select(*keys)
    if again.isEmpty():
        return found
    wider = solved(checkpointed(each.select(*keys, left, *others).join(again, keys, "left_semi")), keys, left, others, lists, attempt + 1)
    return found.where(~failed).unionByName(wider)


def compare_with_edits(documents: DataFrame, id: str = "doc_id", text: str = "text", lists: bool = True) -> DataFrame:
    """Each document's fingerprint, that of an edited text, and the paragraphs that differ.

    Columns: id, n_chars, edited_sha256, fingerprint, edited_fingerprint, n_paragraphs, n_edited, n_next (of the text, the edited and the following one),
    near_edited, near_next and, with ``lists``, the digests removed_edited, added_edited, removed_next, added_next. The edited text has the last half (rounded down) of the
    code points replaced by as many of the first of the next document, ascending ids; after the last comes the first. Null texts are empty, null ids come
    before all others, documents with one id are ordered by a digest of their texts. Rows equal in id and text count as one document, with a row of
    its own for each. ``near`` is twice the number of common paragraphs over the number of both sides', 1 if neither has any.
    Texts with the same paragraphs in another order have equal fingerprints. No documents give no rows, other columns are left aside.
    """
    rows = keyed(documents, id, text)
    texts = rows.dropDuplicates(KEYS)  # by the keys of the joins that follow: one shuffle of whole texts
    each = versions(texts, checkpointed(successors(rows)))
    sizes = [F.size(v).alias(f"n_{v}") for v in ("mine", *PAIRS)]
    prints = [written(sketch(F.col(v))).alias(name) for v, name in (("mine", "fingerprint"), ("edited", "edited_fingerprint"))]
    each = checkpointed(each.select("*", *sizes, *prints))  # read by each attempt
    found = each.drop("mine", *PAIRS).join(solved(each, KEYS, "mine", PAIRS, lists), KEYS, "left")

    def near(other: str) -> Column:
        total = F.col("n_mine") + F.col(f"n_{other}")
        differing = F.coalesce(F.col(f"{other}.n_removed") + F.col(f"{other}.n_added"), F.lit(0))
        return F.when(total == 0, F.lit(1.0)).otherwise((total - differing) / total).alias(f"near_{other}")

    none = F.array().cast("array<bigint>")
    digests_of = [F.coalesce(f"{o}.{side}", none).alias(f"{side}_{o}") for o in PAIRS for side in ("removed", "added")] if lists else []
    return found.select("*", F.explode(F.sequence(F.lit(1), F.col("times").cast("int"))).alias("copy")).select(
        F.when(F.col("known"), F.col("id")).alias(id), "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        F.col("n_mine").alias("n_paragraphs"), "n_edited", "n_next", *map(near, PAIRS), *digests_of)
