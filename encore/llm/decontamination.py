"""Benchmark decontamination by template canonicalisation, with DataFrame functions only.

Numbers, names and units of a text become typed placeholders, so a question asked
again with other values keeps its template. Windows of five template tokens of the
documents are hash-joined with those of the benchmark; a document that holds most
windows of an item is a candidate; its slots are then compared: one value of the item must
always have become the same value of the document, or of one passage aligned with the item. Copies word by word and number by number
are found whatever the case of their letters, by windows of plain tokens.

Marking names is costly, so a first pass over all documents looks for runs of three plain words only: an item whose windows mostly hold
such runs can only be in documents with a certain number of them, which follows from the item and leaves nothing out.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from .common import checkpointed

WINDOW, SIMILARITY = 5, 0.8
#: Tokens that a passage may have more or fewer than the item before a window of it.
DRIFT = 8
#: Words of the runs that the first pass looks for.
RUN = 3
#: Windows of a benchmark that are broadcast, at most (some 24 bytes each); more are joined by a shuffle.
BROADCAST_WINDOWS = 1_000_000

NUMBER = r"\p{N}+(?:[.,:/]\p{N}+)*"
#: Capitalised at the start of a sentence, these are no names.
FUNCTION_WORDS = (
    "a|about|after|all|also|although|an|and|another|any|are|as|at|because|before|both|but|by|calculate|can|could|determine|did|do|does|"
    "during|each|either|every|few|find|finally|first|for|from|given|had|has|have|he|her|here|his|how|however|i|if|in|is|it|its|just|"
    "let|many|more|most|much|my|neither|next|no|not|now|of|on|one|only|or|other|our|out|over|she|should|since|so|some|such|suppose|than|"
    "that|the|their|them|then|there|therefore|these|they|this|those|though|thus|to|two|under|until|up|was|we|were|what|when|where|"
    "whether|which|while|who|whom|whose|why|with|without|would|yet|you|your|"
    "aber|alle|als|am|an|auch|auf|aus|bei|bis|da|dann|das|dass|dem|den|der|des|die|dies|diese|dieser|doch|durch|ein|eine|einem|einen|"
    "einer|eines|er|es|für|hat|hatte|ich|ihr|ihre|im|ist|jede|jeder|jedes|kein|keine|man|mit|nach|nicht|noch|nun|nur|ob|oder|seine|"
    "sie|sind|um|und|unter|vom|von|vor|wann|warum|was|weil|welche|welcher|wenn|wer|wie|wieviel|wir|wo|zu|zum|zur|zwei|"
    "après|au|aux|avant|avec|ce|ces|cet|cette|chaque|combien|comme|comment|dans|de|deux|donc|du|elle|elles|en|est|et|il|ils|je|la|le|"
    "les|leur|lorsque|mais|ne|nous|où|ou|par|pas|pendant|plus|pour|pourquoi|quand|que|quel|quelle|quels|qui|sa|sans|ses|si|son|sous|sur|"
    "tous|tout|toutes|très|un|une|vous|"
    "al|antes|aunque|cada|como|cómo|con|cual|cuál|cuando|cuándo|cuanto|cuánto|cuántos|cuántas|del|desde|después|donde|dónde|dos|el|ella|"
    "ellos|entonces|entre|era|esta|este|esto|hasta|hay|las|lo|los|luego|mientras|muy|no|para|pero|por|porque|pues|qué|quién|se|según|ser|"
    "sin|sobre|son|su|sus|también|todo|todos|una|y|ya|yo"
)
#: A run of capitalised words, wherever it stands; a function word ends it.
_BY_LETTER = {w[0]: [v[1:] for v in FUNCTION_WORDS.split("|") if v[0] == w[0]] for w in FUNCTION_WORDS.split("|")}
_FUNCTION = "|".join(f"{letter}(?:{'|'.join(dict.fromkeys(rest))})" for letter, rest in _BY_LETTER.items())
_WORD = rf"(?!(?i:{_FUNCTION})(?![\p{{L}}\p{{M}}]))\p{{Lu}}[\p{{L}}\p{{M}}]*"
NAME = rf"(?=\p{{Lu}})(?<![\p{{L}}\p{{M}}])(?<!⟦u:){_WORD}(?: {_WORD})*"
#: Fixed words that count as units after a number.
UNITS = (
    "%|percent|kg|g|mg|km|m|cm|mm|miles|mile|metres|meters|feet|inches|litres|liters|l|ml|seconds|second|minutes|minute|"
    "hours|hour|days|day|weeks|week|months|month|years|year|dollars|dollar|euros|euro|cents|cent|pounds|pound|apples|"
    "prozent|jahre|tage|stunden|minuten|heures|jours|ans|horas|años"
)
UNIT = rf"(?i)(⟦n:[^⟧]*⟧ ?)({UNITS})(?![\p{{L}}\p{{N}}])"
#: Letters of scripts that put no blanks between words (Thai to Myanmar, Khmer, kana, Bopomofo, Han); each is a token.
#: Ranges, as every letter of every text is tried: a lookup of its script takes far longer.
UNSPACED = r"[\u0E00-\u109F\u1780-\u17FF\u3005-\u3007\u3040-\u312F\u31A0-\u31FF\u3400-\u4DBF\u4E00-\u9FFF\uF900-\uFAFF\x{20000}-\x{323AF}]"
SLOT = r"⟦[nup]:([^⟧]*)⟧"


def marked(text: Column) -> Column:
    """The text with each number, unit and name as ``⟦kind:value⟧``."""
    plain = F.translate(F.coalesce(text, F.lit("")), "⟦⟧", "  ")
    plain = F.regexp_replace(plain, NUMBER, "⟦n:$0⟧")
    plain = F.regexp_replace(plain, UNIT, "$1 ⟦u:$2⟧")
    return F.regexp_replace(plain, NAME, "⟦p:$0⟧")


def _cut_tokens(text: Column, others: str) -> Column:
    """Words and what ``others`` matches, in order; letters of scripts without blanks are single."""
    words = F.regexp_extract_all(text, F.lit(rf"{others}|[\p{{L}}\p{{M}}]+"), F.lit(0))
    single = F.regexp_extract_all(text, F.lit(rf"{others}|{UNSPACED}\p{{M}}*|(?:(?!{UNSPACED})[\p{{L}}\p{{M}}])+"), F.lit(0))
    return F.when(F.rlike(text, F.lit(UNSPACED)), single).otherwise(words)


def plain(text: Column) -> Column:
    """Lower-cased words and numbers of a text."""
    return _cut_tokens(F.lower(F.coalesce(text, F.lit(""))), r"\p{N}+")


def is_slot(token: Column) -> Column:
    return F.startswith(token, F.lit("⟦"))


def template(tokens: Column) -> Column:
    """Lower-cased words and placeholders without their values."""
    return F.transform(tokens, lambda t: F.when(is_slot(t), F.concat(F.left(t, F.lit(2)), F.lit("⟧"))).otherwise(F.lower(t)))


def slot_values(tokens: Column) -> Column:
    """The values of placeholders, null for words."""
    return F.transform(tokens, lambda t: F.when(is_slot(t), F.substring(t, F.lit(4), F.char_length(t) - 4)))


def _starts(tokens: Column, width: int) -> Column:
    return F.when(F.size(tokens) >= width, F.sequence(F.lit(1), F.size(tokens) - width + 1)).otherwise(
        F.array().cast("array<int>"))


def _cut(width: int, short: Sequence[int]) -> Column:
    """Windows (place, hash, values) of the columns ``tokens`` and ``values``: those of ``width`` tokens, and those as long
    as the short items. A short window without a word says something by its values only, so they are hashed with it."""
    def each(length: int) -> Column:
        def window(i: Column) -> Column:
            cut, values = F.slice("tokens", i, length), F.slice("values", i, length)
            plain = F.xxhash64(cut)
            if length < width:
                plain = F.when(F.exists(cut, lambda t: ~F.startswith(t, F.lit("⟦"))), plain).otherwise(F.xxhash64(
                    cut, F.transform(values, lambda v: F.lower(v))))
            return F.struct((i - 1).alias("place"), plain.alias("hash"), values.alias("values"))

        return F.transform(_starts(F.col("tokens"), length), window)

    return F.concat(*map(each, [width, *short])) if short else each(width)


def _whole(width: int) -> Column:
    """Windows of an item: of fewer tokens than ``width`` the whole sequence is the one window."""
    size = F.size("tokens")
    return F.when(size >= width, _cut(width, ())).otherwise(
        F.filter(_cut(width, range(1, width)), lambda w: F.size(w["values"]) == size))


def _valued(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, tokens, values) of the column ``marked``; values are null where a token is a word.

    Tokens are a column of their own before windows are cut: inside a lambda an expression would be
    evaluated again for every window.
    """
    cut = rows.select(*keys, _cut_tokens(F.col("marked"), r"⟦[nup]:[^⟧]*⟧").alias("cut"))
    return cut.select(*keys, template(F.col("cut")).alias("tokens"), slot_values(F.col("cut")).alias("values"))


def _hashes(width: int) -> Column:
    return F.transform(_starts(F.col("tokens"), width), lambda i: F.xxhash64(F.slice("tokens", i, width)))


def windows(rows: DataFrame, key: str, width: int = WINDOW, short: Sequence[int] = ()) -> DataFrame:
    """(key, hash) of all windows of the column ``marked``; values are only needed for short ones."""
    valued = _valued(rows, [key])
    cut = F.transform(_cut(width, short), lambda w: w["hash"]) if short else _hashes(width)
    return valued.select(key, F.explode(cut).alias("hash"))


def plain_windows(rows: DataFrame, key: str, width: int) -> DataFrame:
    """(key, hash) of all windows of the plain tokens of the column ``text``."""
    return rows.select(key, plain(F.col("text")).alias("tokens")).select(key, F.explode(_hashes(width)).alias("hash"))


def _run_of(tokens: Column, at: Column) -> Column:
    """Hash of the run of plain words at a place, null if it has a placeholder or ends before."""
    run = F.slice(tokens, at, RUN)
    return F.when((F.size(run) == RUN) & ~F.exists(run, is_slot), F.xxhash64(run))


def first_pass(items: DataFrame, width: int, similarity: float) -> tuple[DataFrame, DataFrame]:
    """(item, run, needed) of the items that the first pass can look for, and (item) of the others.

    ``items`` has (item, text, marked). A document that holds ``similarity`` of an item's windows, be it of the template or of plain tokens, misses
    ``lost`` at most; of those that hold a run of words of the template it has thus ``held - lost`` at least. One run serves
    ``most`` windows at most, so there are (held - lost) / most different runs of the item in the document. Where that is not positive the item needs the others' way.
    """
    words = _valued(items, ["item"]).select("item", "tokens")
    runs = words.select("item", F.explode(F.transform(_starts(F.col("tokens"), RUN), lambda i: _run_of(F.col("tokens"), i))).alias("run"))
    runs = checkpointed(runs.where("run IS NOT NULL").distinct())

    def needed(rows: DataFrame, name: str) -> DataFrame:
        parts = F.transform(F.sequence(F.lit(0), F.lit(width - RUN)), lambda j: _run_of(F.col("tokens"), F.col("i") + j))
        starts = rows.select("item", "tokens", F.explode(_starts(F.col("tokens"), width)).alias("i"))
        each = starts.select("item", F.xxhash64(F.slice("tokens", F.col("i"), width)).alias("hash"), F.explode_outer(parts).alias("run"))
        total = each.groupBy("item").agg(F.count_distinct("hash").alias("n"))
        inside = each.join(runs, ["item", "run"], "left_semi").select("item", "hash", "run").distinct()
        held = inside.groupBy("item").agg(F.count_distinct("hash").alias("held"))
        most = inside.groupBy("item", "run").agg(F.count("*").alias("c")).groupBy("item").agg(F.max("c").alias("most"))
        left = F.col("held") - (F.col("n") - F.ceil(F.col("n") * similarity))
        return total.join(held, "item").join(most, "item").select("item", F.ceil(left / F.col("most")).alias(name))

    both = needed(words, "a").join(needed(items.select("item", plain(F.col("text")).alias("tokens")), "b"), "item")
    known = checkpointed(both.select("item", F.least("a", "b").alias("needed")).where("needed >= 1"))
    return runs.join(known, "item"), items.select("item").distinct().join(known, "item", "left_anti")


def occurrences(rows: DataFrame, keys: Sequence[str], at: str, name: str, cut: Column) -> DataFrame:
    """(keys, at, hash, values) of every window of ``cut``; values are null where a token is a word."""
    each = _valued(rows, keys).select(*keys, F.explode(cut).alias("w"))
    return each.select(*keys, F.col("w.place").alias(at), "w.hash", F.col("w.values").alias(name))


def _kept_values(matches: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, n_slots, same_slots) of matched windows: distinct values of the item, and those that became one value."""
    pairs = matches.select(*keys, F.explode(F.arrays_zip("asked", "given")).alias("v")).where(
        "v.asked IS NOT NULL AND v.given IS NOT NULL")
    per_value = pairs.groupBy(*keys, F.lower("v.asked").alias("asked")).agg(
        F.min(F.lower("v.given")).alias("low"), F.max(F.lower("v.given")).alias("high"))
    return per_value.groupBy(*keys).agg(
        F.count("*").alias("n_slots"), F.count_if(F.col("low") == F.col("high")).alias("same_slots"))


def _passages(matches: DataFrame, totals: DataFrame, similarity: float) -> DataFrame:
    """(id, item, n_slots, same_slots) of the pairs of which one aligned passage holds the item with consistent slots.

    A passage is an offset of a document's places to an item's, with the windows at most ``DRIFT`` off it; each
    window of the item counts there once, where it is nearest, so equal windows elsewhere say nothing.
    """
    rows = ["id", "row", "item", "item_row"]
    offset = F.col("there") - F.col("here")
    offsets = matches.select(*rows, offset.alias("anchor")).distinct()
    near = matches.withColumn("anchor", F.explode(F.sequence(offset - DRIFT, offset + DRIFT))).join(
        offsets, [*rows, "anchor"], "left_semi")
    chosen = near.groupBy(*rows, "anchor", "here").agg(F.min_by(
        F.struct("hash", "asked", "given"), F.struct(F.abs(offset - F.col("anchor")), offset)).alias("w")).select(
        *rows, "anchor", "w.*")
    held = chosen.groupBy(*rows, "anchor").agg(F.count_distinct("hash").alias("held")).join(totals, ["item", "item_row"])
    whole = held.where(F.col("held") >= similarity * F.col("n_row"))
    judged = whole.join(_kept_values(chosen, [*rows, "anchor"]), [*rows, "anchor"])
    judged = judged.where(F.col("same_slots") >= similarity * F.col("n_slots"))
    best = F.max_by(F.struct("n_slots", "same_slots"), F.struct(F.col("same_slots") / F.col("n_slots"), "n_slots", "held"))
    return judged.groupBy("id", "item").agg(best.alias("b")).select("id", "item", "b.*")


def contaminated(
    documents: DataFrame, benchmark: DataFrame, id: str = "doc_id", text: str = "text", item: str = "item_id",
    width: int = WINDOW, similarity: float = SIMILARITY,
) -> DataFrame:
    """(id, item, n_windows, found, share, n_slots, same_slots) for each document that holds a benchmark item.

    ``share`` of the item's distinct windows are in the document, ``similarity`` at least. ``n_slots`` counts the distinct
    slot values of the item in shared windows, ``same_slots`` those that always became one value of the document; a pair
    is returned if that holds for the same share of them, or without slots. Where it does not hold over the whole document, one aligned
    passage that holds the same share of the item's windows suffices, and both numbers are that passage's. Where neither holds, the same share of windows of plain
    tokens (words in any case and numbers) suffices: ``n_windows`` and ``found`` count those, and there are no slots. An item of fewer tokens than a window is one window of all its
    tokens, without words one of its values; items without tokens match nothing, null texts are empty, rows with a null id or item cannot be named and are left out. Rows with one
    id count as one document, also with one item id as one item. Empty tables give no
    rows; extra columns are ignored.
    """
    items = benchmark.select(F.col(f"`{item}`").alias("item"), F.col("text"), marked(F.col("text")).alias("marked")).where("item IS NOT NULL")
    asked = occurrences(items.select("item", F.xxhash64("marked").alias("item_row"), "marked").distinct(),
                        ["item", "item_row"], "here", "asked", _whole(width))
    asked = checkpointed(asked)  # read several times
    short = [r[0] for r in asked.where(F.size("asked") < width).select(F.size("asked")).distinct().collect()]  # below width
    item_windows = asked.select("item", "hash").distinct()
    totals = item_windows.groupBy("item").agg(F.count("*").alias("n_windows"))
    source = documents.select(F.col(f"`{id}`").alias("id"), F.col(f"`{text}`").alias("text")).where("id IS NOT NULL")
    few = item_windows.count() <= BROADCAST_WINDOWS

    def small(side: DataFrame) -> DataFrame:
        return F.broadcast(side) if few else side

    def shared(found: DataFrame, wanted: DataFrame) -> DataFrame:
        """(id, item, found): how many different hashes of an item a document has."""
        once = found.join(small(wanted), "hash").groupBy("id", "item", "hash").agg(F.lit(1).alias("one"))
        return once.groupBy("id", "item").agg(F.count("*").alias("found"))

    runs, other_items = first_pass(items, width, similarity)
    runs, other_items = checkpointed(runs), checkpointed(other_items)
    needed = runs.select("item", "needed").distinct()
    hits = shared(plain_windows(source, "id", RUN), runs.select("item", F.col("run").alias("hash")))
    suspects = checkpointed(hits.join(small(needed), "item").where("found >= needed").select("id", "item"))
    suspected = source.join(suspects.select("id").distinct(), "id", "left_semi")

    def both_ways(cut, wanted: DataFrame, totals: DataFrame) -> DataFrame:
        """(id, item, n_windows, found) of pairs that share enough windows: suspected ones, and all documents for the other items."""
        counted = shared(cut(suspected), wanted.join(small(needed.select("item")), "item", "left_semi")).join(suspects, ["id", "item"], "left_semi")
        if not other_items.isEmpty():
            counted = counted.unionByName(shared(cut(source), wanted.join(small(other_items), "item", "left_semi")))
        return counted.join(small(totals), "item").where(F.col("found") >= similarity * F.col("n_windows")).select("id", "item", "n_windows", "found")

    candidates = both_ways(lambda rows: windows(rows.select("id", marked(F.col("text")).alias("marked")), "id", width, short),
                           item_windows, totals)
    plain_items = checkpointed(plain_windows(items, "item", width).distinct())
    copies = both_ways(lambda rows: plain_windows(rows, "id", width), plain_items, plain_items.groupBy("item").agg(F.count("*").alias("n_windows")))
    candidates = checkpointed(candidates)  # read several times

    def matches(pairs: DataFrame) -> DataFrame:
        suspects = source.join(pairs.select("id").distinct(), "id", "left_semi").select(
            "id", F.xxhash64("text").alias("row"), marked(F.col("text")).alias("marked"))
        return occurrences(suspects, ["id", "row"], "there", "given", _cut(width, short)).join(
            pairs.select("id", "item").join(small(asked), "item"), ["id", "hash"])

    with_slots = matches(candidates).where(F.exists("asked", lambda v: v.isNotNull()))
    judged = candidates.join(_kept_values(with_slots, ["id", "item"]), ["id", "item"], "left").na.fill(0, ["n_slots", "same_slots"])
    judged = checkpointed(judged)  # read twice
    consistent = F.col("same_slots") >= similarity * F.col("n_slots")
    found, open_pairs = judged.where(consistent), judged.where(~consistent)
    if not open_pairs.isEmpty():
        # some values became several over all pairings of equal windows: judge them passage by passage
        row_totals = asked.groupBy("item", "item_row").agg(F.count_distinct("hash").alias("n_row"))
        passages = _passages(checkpointed(matches(open_pairs)), small(row_totals), similarity)
        found = found.unionByName(open_pairs.drop("n_slots", "same_slots").join(passages, ["id", "item"]))
    found = checkpointed(found)  # read twice
    verbatim = copies.join(found, ["id", "item"], "left_anti").select(
        "id", "item", "n_windows", "found", F.lit(0).cast("long").alias("n_slots"), F.lit(0).cast("long").alias("same_slots"))
    found = found.select("id", "item", "n_windows", "found", "n_slots", "same_slots").unionByName(verbatim)
    return found.select(
        F.col("id").alias(id), F.col("item").alias(item), "n_windows", "found",
        (F.col("found") / F.col("n_windows")).alias("share"), "n_slots", "same_slots")
