"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests.

A text is the set of its paragraphs' 64-bit digests; paragraphs are sentences of lines, and long ones are
cut to pieces at words by their hashes, so that they are not lost as a whole when one end changes.
The sketch has three subtables; each digest goes into one cell of each, and a cell holds the number of
its digests, their XOR and the XOR of their checks.  Subtracting two sketches cell by cell cancels what
they share.  A cell that is left with one digest (its check fits) gives it away; taking it out of its
other cells frees further ones, until all differing digests are recovered.

The squares of the numbers left in the cells of a difference estimate how many digests differ.  Where
that is more than the sketches can give back, or where peeling gets stuck, both are made anew in a size
by the estimate, and four times as large whenever that fails.  The next document is mostly another text
altogether, so that comparison starts with room for all digests of both.  Only cells that are not
empty are kept, so a large sketch costs what its digests cost.  DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayflux.llm.common import NO_ID, only, stored

TABLES = 3
#: Cells of each subtable of a published fingerprint, and the factor by which a failed pair grows.
CELLS, GROWTH = 16, 4
#: Rounds of peeling after which a pair counts as failed; those that succeed need about log log of its size.
_ROUNDS = 32
#: A published sketch is tried where it has this many cells for each digest that is estimated to differ;
#: others are made with more, so that most digests are alone in a cell at once.
ROOM, AMPLE = 2, 6
#: A sentence longer than this is cut after each word whose hash is a multiple of ``_EVERY``.
PIECE, _EVERY = 400, 8
#: A word longer than this is cut in the same way, after characters with those before them.
_WORD, _GRAM, _LETTERS = 100, 4, 32
#: Ids in one neighbourhood when texts meet the text after them, and how many of these there may be.
_BUCKET, _NEIGHBOURHOODS, _STRIDE = 256, 65_536, 256
_OTHERS = ("edited", "next")
_LIST = "array<bigint>"
_CELLS = "array<struct<i:int,n:bigint,key:bigint,check:bigint>>"


def _bound(value: Column, use) -> Column:
    """``use(value)`` with the value worked out once; a plain reference would repeat it at each use."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _cut(units: Column, between: str, ends) -> Column:
    """``units`` joined to pieces that end where ``ends(units, k)`` holds for the k-th, or with the last."""
    def pieces(u: Column) -> Column:
        last = F.size(u)
        places = F.filter(F.sequence(F.lit(1), last), lambda k: (k == last) | ends(u, k))
        return _bound(places, lambda at: F.transform(at, lambda k, i: _bound(
            F.when(i == 0, F.lit(0)).otherwise(F.get(at, i - 1)),
            lambda start: F.array_join(F.slice(u, start + 1, k - start), between))))

    return _bound(units, pieces)


def _letters(word: Column) -> Column:
    """Pieces of a word that is too long, by its characters."""
    return F.when(F.length(word) <= _WORD, F.array(word)).otherwise(_cut(
        F.split(word, ""), "", lambda u, k: (k >= _GRAM) & (F.pmod(F.xxhash64(F.slice(
            u, F.greatest(k - _GRAM + 1, F.lit(1)), F.lit(_GRAM))), F.lit(_LETTERS)) == 0)))


def _pieces(sentence: Column) -> Column:
    """A sentence, in pieces where it is long: their ends depend on the words there, not on places."""
    words = F.flatten(F.transform(F.split(sentence, " "), _letters))
    return F.when(F.length(sentence) <= PIECE, F.array(sentence)).otherwise(_cut(
        words, " ", lambda u, k: F.pmod(F.xxhash64(F.get(u, k - 1)), F.lit(_EVERY)) == 0))


def digests(text: str | Column) -> Column:
    """Sorted distinct digests of the paragraphs of a text; those of white space only are left out."""
    sentences = F.flatten(F.transform(F.split(text, "\n"), lambda x: F.split(x, r"(?<=[.!?]) ")))
    parts = _bound(sentences, lambda found: F.when(
        F.exists(found, lambda x: F.length(x) > PIECE), F.flatten(F.transform(found, _pieces))).otherwise(found))
    return F.coalesce(F.array_sort(F.array_distinct(F.transform(
        F.filter(parts, lambda x: F.trim(x) != ""), lambda x: F.xxhash64(x)))), F.array().cast(_LIST))


def _check(key: Column) -> Column:
    return F.xxhash64(key, F.lit("check")).bitwiseAND(F.lit(0xFFFFFFFF))


def _cell(places: Column, table: int, cells: Column) -> Column:
    """The place of a digest in the whole sketch, for one subtable: bits of one hash, as sizes are powers
    of two up to 2^21."""
    return (F.shiftrightunsigned(places, 21 * table).bitwiseAND(cells - 1) + cells * table).cast("int")


def _entry(i: Column, n: Column, key: Column, check: Column) -> Column:
    return F.struct(i.alias("i"), n.cast("bigint").alias("n"), key.alias("key"), check.alias("check"))


def _merged(entries: Column) -> Column:
    """Cells of a sketch from entries in any order: those of one place add up, empty ones go.

    Numbers that hold place and position are sorted, not the entries; those of one place then follow
    each other, and each such run is added up by itself.
    """
    low = F.lit((1 << 32) - 1)

    def cells(e: Column, at: Column) -> Column:
        def entry(k: Column) -> Column:
            return F.get(e, k.bitwiseAND(low).cast("int"))

        def added(first: Column, rest: Column) -> Column:
            return F.aggregate(rest, first, lambda a, k: _bound(entry(k), lambda x: _entry(
                a["i"], a["n"] + x["n"], a["key"].bitwiseXOR(x["key"]), a["check"].bitwiseXOR(x["check"]))))

        starts = F.filter(F.sequence(F.lit(0), F.size(at) - 1), lambda k: (k == 0) | (
            F.shiftright(F.get(at, k), 32) != F.shiftright(F.get(at, k - 1), 32)))
        runs = _bound(starts, lambda s: F.transform(s, lambda k, j: _bound(
            F.coalesce(F.get(s, j + 1), F.size(at)) - k,
            lambda n: F.when(n == 1, entry(F.get(at, k))).otherwise(
                added(entry(F.get(at, k)), F.slice(at, k + 2, n - 1))))))
        return F.filter(runs, lambda c: (c["n"] != 0) | (c["key"] != 0) | (c["check"] != 0))

    def placed(e: Column) -> Column:
        return F.sort_array(F.transform(e, lambda x, k: F.shiftleft(x["i"].cast("bigint"), 32) + k))

    return _bound(entries, lambda e: F.when(F.size(e) > 0, _bound(placed(e), lambda at: cells(e, at))).otherwise(
        F.array().cast(_CELLS)))


def _entries(key: Column, n: Column, check: Column, cells: Column) -> Column:
    return _bound(F.struct(F.xxhash64(key, cells).alias("places"), check.alias("check")), lambda h: F.array(*[
        _entry(_cell(h["places"], j, cells), n, key, h["check"]) for j in range(TABLES)]))


def _cells(size: int | Column) -> Column:
    return (F.lit(size) if isinstance(size, int) else size).cast("bigint")


def sketch(keys: Column, cells: int = CELLS) -> Column:
    """The cells of 3 * ``cells`` that are not empty, as structs (i, n, key, check) by place."""
    return _merged(_signed(keys, 1, _cells(cells)))


def subtracted(a: str, b: str) -> Column:
    """What one sketch has more than another; shared digests cancel."""
    return _merged(F.concat(F.col(a), F.transform(b, lambda c: _entry(c["i"], -c["n"], c["key"], c["check"]))))


def _signed(keys: Column, n: int, cells: Column) -> Column:
    return F.flatten(F.transform(keys, lambda d: _entries(d, F.lit(n), _check(d), cells)))


def difference(a: str, b: str, cells: int | Column) -> Column:
    """What subtracting the sketches of two lists of digests gives; sketches are sums, so one pass does."""
    return _merged(F.concat(_signed(F.col(a), 1, _cells(cells)), _signed(F.col(b), -1, _cells(cells))))


def estimated(cells_left: Column, a: Column, b: Column, cells: int) -> Column:
    """About how many digests two sketches differ in, from their difference and their sizes.

    A digest adds 1 or -1 to one random cell of each subtable, so the squares of the sums add up to the
    number of differing digests, but for what the difference of the sizes puts into all cells.
    """
    squares = F.aggregate(cells_left, F.lit(0).cast("bigint"), lambda s, c: s + c["n"] * c["n"]) / TABLES
    return F.greatest(F.abs(a - b), (squares - (a - b) * (a - b) / cells) / (1 - 1 / cells))


def peeled(difference: Column, cells: int | Column = CELLS) -> Column:
    """Struct (cells, mine, theirs, live): the digests recovered for each side, and what is left over.

    A subtable holds every differing digest once, so its numbers, keys and checks as a whole tell when the
    last one is found; cells are only worked through where some are missing.
    """
    none, zero = F.array().cast(_LIST), F.lit(0).cast("bigint")

    def alone(state: Column, n: int) -> Column:
        return F.array_distinct(F.transform(F.filter(
            state["cells"], lambda c: (c["n"] == n) & (c["check"] == _check(c["key"]))), lambda c: c["key"]))

    def left(state: Column, found: Column) -> Column:
        """XOR of keys and of checks in the first subtable, without what was found."""
        def out(a: Column, key: Column) -> Column:
            return F.struct(a["key"].bitwiseXOR(key).alias("key"), a["check"].bitwiseXOR(_check(key)).alias("check"))

        return F.aggregate(F.concat(found["mine"], found["theirs"]), state["left"], out)

    def step(state: Column, _: Column) -> Column:
        found = F.struct(alone(state, 1).alias("mine"), alone(state, -1).alias("theirs"))

        def next_state(f: Column, rest: Column) -> Column:
            over = (rest["key"] == 0) & (rest["check"] == 0)
            some = F.size(f["mine"]) + F.size(f["theirs"]) > 0
            return F.struct(
                F.when(over, F.array().cast(_CELLS)).when(some, _merged(F.concat(
                    state["cells"], _signed(f["mine"], -1, _cells(cells)), _signed(f["theirs"], 1, _cells(cells)))))
                .otherwise(state["cells"]).alias("cells"),
                F.concat(state["mine"], f["mine"]).alias("mine"),
                F.concat(state["theirs"], f["theirs"]).alias("theirs"),
                (some & ~over).alias("live"), rest.alias("left"))

        return F.when(~state["live"], state).otherwise(_bound(found, lambda f: _bound(
            left(state, f), lambda rest: next_state(f, rest))))

    def all_of(d: Column) -> Column:
        return F.aggregate(F.filter(d, lambda c: c["i"] < _cells(cells)), F.struct(
            zero.alias("key"), zero.alias("check")), lambda a, c: F.struct(
            a["key"].bitwiseXOR(c["key"]).alias("key"), a["check"].bitwiseXOR(c["check"]).alias("check")))

    return _bound(difference, lambda d: F.aggregate(F.sequence(F.lit(1), F.lit(_ROUNDS)), F.struct(
        d.alias("cells"), none.alias("mine"), none.alias("theirs"), (F.size(d) > 0).alias("live"),
        all_of(d).alias("left")), step))


def likeness(count: Column, peel: Column) -> Column:
    """Shared over all paragraphs, from the number of one side and the peeled difference; null where
    cells are left over.  Two texts without paragraphs are alike."""
    def ratio(p: Column) -> Column:
        union = count + F.size(p["theirs"])
        return F.when(F.size(p["cells"]) == 0, F.when(union == 0, F.lit(1.0)).otherwise(
            (count - F.size(p["mine"])) / union))

    return _bound(peel, ratio)


def written(cells: str) -> Column:
    """A sketch as text: place, number, key and check of each cell that is not empty."""
    return F.concat_ws(",", F.transform(cells, lambda c: F.lower(F.concat_ws(
        "-", c["i"].cast("string"), F.hex(c["n"]), F.hex(c["key"]), F.hex(c["check"])))))


def _bounds(places: DataFrame, size: int) -> list[tuple[int, int]]:
    """The first (id, tie) of each neighbourhood of about ``size`` places; at most 65,536."""
    placed = stored(
        places.distinct().repartitionByRange("id", "tie").sortWithinPartitions("id", "tie")
        .withColumn("at", F.monotonically_increasing_id())
        .select("id", "tie", F.shiftright("at", 33).alias("part"), F.col("at").bitwiseAND(F.lit((1 << 33) - 1)).alias("at")),
        "ids")
    total, bases = 0, []
    for part, n in sorted(placed.groupBy("part").count().collect()):  # a row for each partition
        bases.append((part, total))
        total += n
    step = max(size, -(-total // _NEIGHBOURHOODS))
    bases = places.sparkSession.createDataFrame(bases, "part bigint, base bigint")
    firsts = placed.join(F.broadcast(bases), "part").where((F.col("base") + F.col("at")) % step == 0)
    return sorted((r["id"], r["tie"]) for r in firsts.select("id", "tie").collect())


def with_next(docs: DataFrame, size: int = _BUCKET) -> DataFrame:
    """``doc_id, text, next_text, times`` of each document in ascending doc_id, the first after the last.

    Null ids come first, texts of one id in the order of their hashes; null texts are empty.  Rows that
    repeat id and text are one document with their number in ``times``.  Ids and hashes alone are sorted
    to cut them into neighbourhoods of ``size`` documents, more where that would be over 65,536 of them;
    texts are shuffled once, each neighbourhood with the document after it, and are windows of their own.
    """
    rows = only(docs, doc_id="bigint", text="string").select(
        F.coalesce("doc_id", F.lit(NO_ID)).alias("id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text"))
    firsts = _bounds(rows.select("id", "tie"), size) or [(NO_ID, 0)]
    kind = "array<struct<id:bigint,tie:bigint>>"

    def literal(found: list[tuple[int, int]]) -> Column:
        return F.from_json(F.lit(str([{"id": i, "tie": t} for i, t in found]).replace("'", '"')), kind)

    here, bounds = F.struct("id", "tie"), literal(firsts)
    placed = rows.withColumn("here", here).withColumn(
        "block", F.size(F.filter(literal(firsts[::_STRIDE]), lambda x: x <= F.col("here"))) - 1).withColumn(
        "own", F.col("block") * _STRIDE + F.size(F.filter(
            F.slice(bounds, F.col("block") * _STRIDE + 1, F.lit(_STRIDE)), lambda x: x <= F.col("here"))) - 1)
    before = F.pmod(F.col("own") - 1, F.lit(len(firsts)))
    stay = F.struct(F.col("own").alias("bucket"), F.lit(False).alias("guest"))
    visit = F.struct(before.alias("bucket"), F.lit(True).alias("guest"))
    homes = F.when(F.get(bounds, F.col("own")) == F.col("here"), F.array(stay, visit)).otherwise(F.array(stay))
    shown = placed.select("id", "tie", "text", F.inline(homes))
    near = "over (partition by bucket order by guest, id, tie)"
    again = "over (partition by bucket order by guest, id, tie range between current row and current row)"
    return (shown.withColumns({
        "repeated": F.expr(f"row_number() {near} > rank() {near}"), "times": F.expr(f"count(*) {again}")})
        .where("not repeated").withColumn("next_text", F.expr(f"lead(text) {near}")).where("not guest")
        .select(F.nullif("id", F.lit(NO_ID)).alias("doc_id"), "text", "next_text", "times"))


def _size(estimate: Column, from_size: int) -> Column:
    """Cells of a subtable with ample room for an estimate, in the series of ``from_size``."""
    steps = F.ceil(F.log(float(GROWTH), F.greatest(AMPLE * estimate / (TABLES * from_size), F.lit(1e-9))))
    return (F.lit(from_size) * F.pow(F.lit(float(GROWTH)), F.greatest(steps, F.lit(0)))).cast("bigint")


def _grown(other: str, tried: Column) -> Column:
    """The size of the next attempt: larger where this one was made and failed."""
    size = F.col(f"{other}_size")
    return F.when(tried & F.col(f"near_{other}").isNull(), size * GROWTH).otherwise(size).alias(f"{other}_size")


def edited_fingerprints(docs: DataFrame, cells: int = CELLS) -> DataFrame:
    """``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``.

    Each text of ``docs`` is compared with an edited version, in which the last half of its characters
    (rounded down) gives way to as many first ones of the next document, and with that next document.
    Fingerprints are ``cells`` cells (a power of two) for each of three subtables; likeness comes from
    peeling their difference, on larger sketches where that fails.  Null and empty texts have empty sketches.  Rows
    that repeat id and text have the same next document and the same result each; an empty table gives
    no rows.  Other columns are not read.
    """
    half = F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(F.left("text", F.length("text") - half), F.left("next_text", half))
    result = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    rows = with_next(docs).select(
        "doc_id", "times", F.length("text").cast("bigint").alias("n_chars"), edited.alias("edited_text"),
        digests("text").alias("own"), digests("next_text").alias("next")).select(
        "doc_id", "times", "n_chars", F.sha2("edited_text", 256).alias("edited_sha256"), "own",
        digests("edited_text").alias("edited"), "next")
    sketched = rows.withColumns({f"{d}_s": sketch(F.col(d), cells) for d in ("own", "edited")})
    left = sketched.withColumn("edited_d", subtracted("own_s", "edited_s"))
    about = estimated(F.col("edited_d"), F.size("own"), F.size("edited"), cells)
    sized = left.withColumns({
        "edited_size": F.when(ROOM * about <= TABLES * cells, cells).otherwise(_size(about, cells)),
        "next_size": _size(F.size("own") + F.size("next"), cells)})
    tried = sized.withColumns({
        "near_edited": F.when(F.col("edited_size") <= cells, likeness(F.size("own"), peeled(F.col("edited_d"), cells))),
        "near_next": likeness(F.size("own"), peeled(difference("own", "next", F.col("next_size")), F.col("next_size")))})
    failed = F.greatest(*[F.col(f"near_{x}").isNull() for x in _OTHERS])
    # Digests are only kept where a comparison is still open.
    needed = {"own": F.when(failed, F.col("own"))} | {
        x: F.when(F.col(f"near_{x}").isNull(), F.col(x)) for x in _OTHERS}
    now = stored(tried.select(
        *result[:3], written("own_s").alias("fingerprint"), written("edited_s").alias("edited_fingerprint"),
        *result[5:], "times", _grown("edited", F.col("edited_size") <= cells), _grown("next", F.lit(True)),
        *[c.alias(d) for d, c in needed.items()]), "sketches")
    parts = [now.where(~failed)]
    now = now.where(failed)
    while not now.isEmpty():
        again = now.withColumns({f"near_{x}": F.coalesce(f"near_{x}", likeness(F.size("own"), peeled(
            difference("own", x, F.col(f"{x}_size")), F.col(f"{x}_size")))) for x in _OTHERS})
        grown = {f"{x}_size": _grown(x, F.lit(True)) for x in _OTHERS}
        now = stored(again.withColumns(grown | needed), "sketches")
        parts.append(now.where(~failed))
        now = now.where(failed)
    out = parts[0].select(*result, "times")
    for part in parts[1:]:
        out = out.unionByName(part.select(*result, "times"))
    return out.select(*result, F.explode(F.sequence(F.lit(1), F.col("times").cast("int"))).alias("time")).select(*result)
