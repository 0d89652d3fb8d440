"""Name matching: codes, corrections, fuzzy matches against a list of valid names.

Scores run from 0 to 100. Names with the same letters and digits score 100, names with the same
words in another order or number 95, others ``100 * (1 - edits / length of the longer name)``. If asked for, names that have all words of
the other score 90 at least.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..binding import Panel
from ..constants import CODE_ALIASES
from ..functions.values import clean_name, relabel, strip_parens
from ..session import settled
from .totals import sums

SAME_WORDS_SCORE = 95.0
SUBSET_SCORE = 90.0
LIST_CHUNK = 1_000
NEAR_SCORE = 80.0
PIVOTS = 8
NEXT_CELLS = 7
FARTHEST = 64  # distances from a pivot from here on lie in one cell
LETTER_KINDS = 8
MORE_SEGMENTS = 12  # of a listed name, where its letters suffice for two each
FEW_NAMES = 1_000
VARIANT_LETTERS = 64  # of a name whose variants are written out; they take the square of its length


def attach_values(dim: DataFrame, values: DataFrame, dim_name: str, value_name: str) -> DataFrame:
    """Every row of the dimension with the values of its name, null where there are none."""
    return dim.join(values, dim[dim_name] == values[value_name], "left")


def iso3(
    df: DataFrame, name: str, dim: DataFrame, aliases: Mapping[str, str] | DataFrame = CODE_ALIASES
) -> DataFrame:
    """Adds ``iso_a3``: the code of a name after alias lookup, else of the name without its
    parenthesised part, else null. Every column of ``dim`` is a name form, ``alpha_3`` included.
    Aliases are a mapping, or a table (raw, fixed) like corrections.
    """
    forms = (
        dim.select("alpha_3", F.explode(F.array(*[F.lower(c) for c in dim.columns])).alias("form"))
        .filter(F.col("form") != "")
        .groupBy("form")
        .agg(F.min("alpha_3").alias("code"))
    )
    tried = apply_fixes(df.withColumn("_tried", clean_name(name)), "_tried", aliases)
    keyed = tried.withColumns({"_full": F.lower("_tried"), "_short": F.lower(strip_parens("_tried"))})
    full = forms.select(F.col("form").alias("_full"), F.col("code").alias("_full_code"))
    short = forms.select(F.col("form").alias("_short"), F.col("code").alias("_short_code"))
    return (
        keyed.join(full, "_full", "left")
        .join(short, "_short", "left")
        .select(*df.columns, F.coalesce("_full_code", "_short_code").alias("iso_a3"))
    )


def valid_names(dim: DataFrame, extra: Iterable[str] | DataFrame, name: str = "name") -> DataFrame:
    """The names of the dimension and the extra names, each once."""
    base = dim.select(F.col(name).alias("name"))
    if isinstance(extra, DataFrame):
        more = extra.select(F.col(extra.columns[0]).alias("name"))
    else:
        more = dim.sparkSession.createDataFrame([(x,) for x in extra], "name string")
    return base.union(more).na.drop().distinct()


def apply_fixes(df: DataFrame, name: str, fixes: Mapping[str, str] | DataFrame) -> DataFrame:
    """Replace the raw names that have a correction. A long list comes as a table (raw, fixed).

    Of several corrections of one name in a table the first by the alphabet counts, so no row is doubled.
    """
    if not isinstance(fixes, DataFrame):
        return df.withColumn(name, relabel(name, fixes))
    table = fixes.groupBy(F.col("raw").alias(name)).agg(F.min("fixed").alias("_fixed"))
    joined = df.join(table, name, "left").withColumn(name, F.coalesce("_fixed", name))
    return joined.select(*df.columns)


def fill_unmatched(
    df: DataFrame, match: str, raw: str, fixes: Mapping[str, str] | DataFrame
) -> DataFrame:
    """Where there is no match, the raw name with its correction, if any."""
    fixed = apply_fixes(df.withColumn("_raw", F.col(raw)), "_raw", fixes)
    return fixed.withColumn(match, F.coalesce(match, "_raw")).drop("_raw")


def match_key(c: Column) -> Column:
    """Lower case, anything but letters and digits as blanks."""
    return F.trim(F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}]", " "))


def word_key(c: Column) -> Column:
    """The words of a match key in order, each once."""
    words = F.array_distinct(F.filter(F.split(c, " +"), lambda w: w != ""))
    return F.array_join(F.array_sort(words), " ")


def similarity(edits: Column, a: Column, b: Column) -> Column:
    longer = F.greatest(F.length(a), F.length(b))
    return F.lit(100.0) * (1 - edits / longer)


def _better(score: Column, match: Column) -> Column:
    """Sorts first for the higher score, then for the name that comes first."""
    return F.when(match.isNotNull(), F.struct((-score).alias("cost"), match.alias("match")))


def _edits(length: Column, threshold: float) -> Column:
    """The most edits that still reach the threshold, by the length of the longer name."""
    return F.floor(length * F.lit((100.0 - threshold) / 100.0) + F.lit(1e-9)).cast("int")


def _most_edits(key: Column, threshold: float) -> Column:
    """The most edits to any partner of this key, however long: it may be longer by as many."""
    return F.floor(F.length(key) * F.lit((100.0 - threshold) / threshold) + F.lit(1e-9)).cast("int")


class _Segments:
    """How names are cut, and where a cut of one may lie in another: SQL over lengths, the same for list and names.

    A listed name of l letters is cut into even segments, one more than edits that a partner may be away, or more where they are longer than two
    letters. Edits spoil a segment each at most, so of its rarest ``edits + 1`` segments one occurs in the partner, shifted by no more than the
    edits left and right of it allow.
    """

    def __init__(self, threshold: float, most: int | None):
        self.threshold, self.cap = threshold, f"{most}" if most else "2147483647"

    def between(self, length: str) -> str:
        """The most edits between names the longer of which has so many letters."""
        return f"least({self.cap}, CAST(floor({length} * {(100.0 - self.threshold) / 100.0}D + 1e-9D) AS INT))"

    def most(self, length: str) -> str:
        """The most edits to a partner of any length."""
        return f"least({self.cap}, CAST(floor({length} * {(100.0 - self.threshold) / self.threshold}D + 1e-9D) AS INT))"

    def number(self, length: str) -> str:
        return f"greatest({self.most(length)} + 1, least({MORE_SEGMENTS}, CAST({length} DIV 2 AS INT)))"

    def cuts(self, length: str, number: str) -> str:
        """Where the segments of a name so long begin, and their sizes: array of (i, start, size)."""
        rest = f"({number} - {length} % {number})"  # from this one on, segments are one letter longer
        start = f"CAST(i * ({length} DIV {number}) + greatest(0, i - {rest}) + 1 AS INT)"
        size = f"CAST({length} DIV {number} + IF(i >= {rest}, 1, 0) AS INT)"
        return f"transform(sequence(0, {number} - 1), i -> struct(i AS i, {start} AS start, {size} AS size))"

    def of_listed(self, key: str) -> str:
        """The segments of a listed name: array of (length, i, text)."""
        n = f"length({key})"
        return f"transform({self.cuts(n, f'({self.number(n)})')}, c -> struct({n} AS length, c.i AS i, substring({key}, c.start, c.size) AS text))"

    def of_name(self, key: str) -> str:
        """All runs of letters that may be a segment of a listed name within reach; ``lengths`` are those of the list."""
        n, shift = f"length({key})", f"(length({key}) - y.l)"
        lengths = f"filter(lengths, l -> l BETWEEN greatest(1, {n} - {self.between(n)}) AND {n} + {self.most(n)})"
        lengths = f"transform({lengths}, l -> struct(l AS l, {self.number('l')} AS number, {self.between(f'greatest(l, {n})')} AS edits))"
        lengths = f"filter({lengths}, y -> abs({shift}) <= y.edits)"
        from_ = f"greatest(1, c.start - CAST(floor((y.edits - {shift}) / 2) AS INT))"
        to = f"least({n} - c.size + 1, c.start + CAST(floor((y.edits + {shift}) / 2) AS INT))"
        runs = f"transform(sequence({from_}, {to}), x -> struct(y.l AS length, c.i AS i, substring({key}, x, c.size) AS text))"
        none = "CAST(array() AS array<struct<length:int,i:int,text:string>>)"
        near = f"flatten(transform({self.cuts('y.l', 'y.number')}, c -> IF({from_} <= {to}, {runs}, {none})))"
        return f"flatten(transform({lengths}, y -> {near}))"


def _candidates(keys: DataFrame, listed: DataFrame, threshold: float, edits: int | None) -> DataFrame:
    """Pairs (key, other, match) of a name's and a listed key among which are all that are near enough."""
    choices = listed.groupBy(F.col("key").alias("other")).agg(F.min("match").alias("match"))
    if edits != 1:
        return _by_segments(keys, choices, threshold, edits)
    short = _by_variants(keys.where(F.length("key") <= VARIANT_LETTERS), choices.where(F.length("other") <= VARIANT_LETTERS + 1))
    long = keys.where(F.length("key") > VARIANT_LETTERS), choices.where(F.length("other") >= VARIANT_LETTERS)
    return short.unionByName(_by_segments(*long, threshold, edits))


def _by_variants(keys: DataFrame, choices: DataFrame) -> DataFrame:
    """Pairs that are equal once each lost a letter or none; all that are one edit apart are among them.

    A variant is known by its hash. Few names share one, however many are listed and however alike they are: they differ in a letter at most.
    """

    def variants(key: str) -> Column:
        less = f"concat(substring({key}, 1, i - 1), substring({key}, i + 1))"
        return F.expr(f"array_distinct(transform(sequence(0, length({key})), i -> xxhash64(IF(i = 0, {key}, {less}))))")

    offered = choices.select("other", "match", F.explode(variants("other")).alias("variant"))
    wanted = keys.select("key", F.explode(variants("key")).alias("variant"))
    # the sizes that a broadcast is chosen by are those before the explosion
    return wanted.join(offered.hint("merge"), "variant").select("key", "other", "match")


def _by_segments(keys: DataFrame, choices: DataFrame, threshold: float, edits: int | None) -> DataFrame:
    """Pairs that share one of the listed key's rarest segments near its place."""
    cut = _Segments(threshold, edits)
    # a segment is known by its hash: another one with the same costs a comparison, no more
    segments = choices.select("other", "match", F.explode(F.expr(f"transform({cut.of_listed('other')}, x -> xxhash64(x))")).alias("segment"))
    frequency = segments.groupBy("segment").agg(F.count("*").alias("n"))
    ranked = F.array_sort(F.collect_list(F.struct("n", "segment")))
    needed = F.expr(cut.most("length(other)")) + 1
    rarest = segments.join(frequency, "segment").groupBy("other", "match").agg(F.slice(ranked, F.lit(1), needed).alias("rarest"))
    offered = rarest.select("other", "match", F.explode("rarest.segment").alias("segment"))
    # as many lengths as the longest listed name has letters, at most
    keys = keys.withColumn("lengths", choices.agg(F.collect_set(F.length("other"))).scalar())
    wanted = keys.select("key", F.explode(F.expr(f"array_distinct(transform({cut.of_name('key')}, x -> xxhash64(x)))")).alias("segment"))
    return wanted.join(offered.hint("merge"), "segment").select("key", "other", "match")


def _nearest_within(keys: DataFrame, listed: DataFrame, threshold: float, edits: int | None = None) -> DataFrame:
    """The best partner of each key that is a candidate and within the threshold, or so many edits: (key, found)."""
    allowed = _Segments(threshold, edits).between("greatest(length(key), length(other))")
    pairs = _candidates(keys, listed, threshold, edits).withColumn("apart", F.expr(f"levenshtein(key, other, {allowed})"))
    near = pairs.where(F.col("apart") >= 0)  # -1 beyond what is allowed
    found = _better(similarity(F.col("apart"), F.col("key"), F.col("other")), F.col("match"))
    return near.select("key", found.alias("found")).groupBy("key").agg(F.min("found").alias("found"))


def _reachable(key: Column, threshold: float, edits: int) -> Column:
    """The highest score of a partner that is so many edits away."""
    return F.lit(100.0) * (1 - F.lit(float(edits)) / (F.length(key) + _most_edits(key, threshold)))


def _letters(key: Column) -> Column:
    """How many letters of each of ``LETTER_KINDS`` kinds a key has."""
    kinds = F.transform(F.split(key, ""), lambda x: F.pmod(F.ascii(x), F.lit(LETTER_KINDS)))
    return F.transform(F.sequence(F.lit(0), F.lit(LETTER_KINDS - 1)), lambda k: F.size(F.filter(kinds, lambda x: x == k)))


def _cell_bound(cell: Column) -> Column:
    """What the best name of a cell can be, as in ``best``: by the triangle inequality and by the lengths of its names."""
    n, away, ring = F.col("n"), F.get("away", cell["pivot"]), cell["ring"]
    apart = F.when(ring == FARTHEST, F.greatest(F.lit(0), ring - away)).otherwise(F.abs(away - ring))
    edits = F.greatest(apart, n - cell["longest"], cell["shortest"] - n)
    return F.struct((F.lit(-100.0) * (1 - edits / F.greatest(n, cell["longest"]))).alias("cost"), cell["match"].alias("match"))


def _visit(keys: DataFrame, cells: Column, pieces: DataFrame, salts: int, places: int) -> DataFrame:
    """Improves ``best`` of each key by the names of the cells it asks for.

    A cell is visited piece by piece. In a piece a name is compared only if the numbers of letters of each kind allow it to be better than what was
    found so far; ``compared`` counts these.
    """

    def step(found: Column, choice: Column) -> Column:
        over = F.aggregate(F.zip_with("letters", choice["letters"], lambda a, b: F.greatest(a - b, F.lit(0))), F.lit(0), lambda x, y: x + y)
        longer = F.greatest(F.col("n"), choice["n"])
        least = over + F.greatest(F.lit(0), choice["n"] - F.col("n"))
        hope = F.struct((F.lit(-100.0) * (1 - least / longer)).alias("cost"), choice["match"].alias("match"))
        apart = F.levenshtein(F.col("key"), choice["key"])
        own = F.struct((F.lit(-100.0) * (1 - apart / longer)).alias("cost"), choice["match"].alias("match"))
        better = F.least(found["best"], own)
        return F.when(hope < found["best"], F.struct(better.alias("best"), (found["compared"] + 1).alias("compared"))).otherwise(found)

    on = ["pivot", "ring", "piece", "salt"]
    asked = (
        keys.select("key", "n", "letters", "best", F.explode(cells).alias("cell"))
        .select("*", "cell.pivot", "cell.ring", F.explode(F.sequence(F.lit(0), F.col("cell.pieces") - 1)).alias("piece"))
        .drop("cell")
        .withColumn("salt", F.pmod(F.xxhash64("key"), F.lit(salts)).cast("int"))
        .repartition(places, *on)  # few bytes, but much work: dealt out by number, which AQE leaves as it is
        .join(pieces, on)
    )
    start = F.struct(F.col("best"), F.lit(0).cast("long").alias("compared"))
    found = asked.select("key", F.aggregate("choices", start, step).alias("found")).groupBy("key").agg(
        F.min("found.best").alias("found"), F.sum("found.compared").alias("more")
    )
    return keys.join(found, "key", "left").select(
        *[c for c in keys.columns if c not in ("best", "compared")],
        F.least("best", "found").alias("best"),
        (F.col("compared") + F.coalesce("more", F.lit(0))).alias("compared"),
    )


def _closest(keys: DataFrame, listed: DataFrame, size: int) -> DataFrame:
    """The best of all listed names for each of the distinct ``keys`` (key, best so far or null): (key, best, compared).

    A metric index: ``PIVOTS`` names are drawn from the list, and each listed name lies in the cell of its nearest pivot and its distance from it. A key
    visits the cells by rising bound: the first, then the next ``NEXT_CELLS``, then every other one that could still hold a better name, or an
    equal one that comes first. There are at most ``PIVOTS * (FARTHEST + 1)`` cells whatever the list; a large cell is cut into pieces of about
    ``LIST_CHUNK`` names. A list of one piece is one cell.
    """
    places = int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salts = max(1, -(-4 * places * LIST_CHUNK // max(size, LIST_CHUNK)))
    many = size > LIST_CHUNK
    drawn = listed.select("key").distinct().orderBy(F.xxhash64("key"), "key").limit(PIVOTS if many else 0)
    pivots = F.coalesce(drawn.agg(F.collect_list("key")).scalar(), F.array().cast("array<string>"))
    away = F.transform("pivots", lambda p: F.levenshtein(F.col("key"), p))

    def placed(df: DataFrame) -> DataFrame:
        own = df.withColumn("pivots", pivots).withColumns({"n": F.length("key"), "letters": _letters(F.col("key")), "away": away})
        return own.drop("pivots")

    nearest = F.array_min("away")
    spot = {"pivot": F.lit(0), "ring": F.lit(FARTHEST)}
    if many:
        spot = {"pivot": F.array_position("away", nearest).cast("int") - 1, "ring": F.least(nearest, F.lit(FARTHEST))}
    index = settled(placed(listed).withColumns(spot).select("match", "key", "n", "letters", *spot), "listed-names")
    cells = index.groupBy(*spot).agg(
        F.min("match").alias("match"),
        F.min("n").alias("shortest"),
        F.max("n").alias("longest"),
        F.ceil(F.count("*") / LIST_CHUNK).cast("int").alias("pieces"),
    )
    pieces = (
        index.join(cells.select(*spot, "pieces"), list(spot))
        .withColumn("piece", F.pmod(F.xxhash64("match"), F.col("pieces")).cast("int"))
        .groupBy(*spot, "piece")
        .agg(F.collect_list(F.struct("match", "key", "n", "letters")).alias("choices"))
        .withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    )
    worst = F.struct(F.lit(1.0).alias("cost"), F.lit("").alias("match"))  # than any name
    keys = placed(keys.select("key", F.coalesce("best", worst).alias("best"), F.lit(0).cast("long").alias("compared")))
    every = cells.agg(F.collect_list(F.struct(*cells.columns))).scalar()
    hopeful = F.filter(
        F.transform("cells", lambda c: F.struct(_cell_bound(c).alias("bound"), *[c[x].alias(x) for x in (*spot, "pieces")])),
        lambda c: c["bound"] < F.col("best"),
    )
    steps: list[tuple[int, int | None]] = [(1, 1), (2, NEXT_CELLS), (2 + NEXT_CELLS, None)] if many else [(1, None)]
    keys = keys.withColumn("cells", every).withColumn("cells", F.array_sort(hopeful))
    for first, count in steps:
        here = F.slice("cells", F.lit(first), F.lit(count) if count else F.greatest(F.lit(0), F.size("cells") - first + 1))
        keys = _visit(keys, F.filter(here, lambda c: c["bound"] < F.col("best")), pieces, salts, places)
        if count:
            keys = settled(keys, "nearest-names")
    return keys.select("key", F.when(F.col("best.cost") <= 0, F.col("best")).alias("best"), "compared")


def _word_subsets(keys: DataFrame, listed: DataFrame, score: float) -> DataFrame:
    """The first listed name of which all words are in a key, or that has all words of it: (key, within).

    A containment join over an inverted index of words: the shorter name asks for, or offers, the one of its words that is rarest in the list.
    """
    own = F.split("words", " ").alias("own")
    known = listed.select("match", own).where(F.array_join("own", "") != "")
    asked = keys.select("key", own).where(F.array_join("own", "") != "")
    by_word = known.select("match", "own", F.explode("own").alias("word"))
    frequency = by_word.groupBy("word").agg(F.count("*").alias("n"))
    rarest = F.min(F.struct("n", "word"))
    asked_words = asked.select("key", "own", F.explode("own").alias("word"))
    # words of the key in the listed name: all must occur in the list
    short = asked_words.join(frequency, "word", "left").groupBy("key", "own").agg(rarest.alias("rarest"), F.count_if(F.col("n").isNull()).alias("new"))
    short = short.where("new = 0").select("key", "own", F.col("rarest.word").alias("word"))
    inside = short.join(by_word.select("match", F.col("own").alias("other"), "word"), "word").where(F.size(F.array_except("own", "other")) == 0)
    offered = by_word.join(frequency, "word").groupBy("match", "own").agg(rarest.alias("rarest")).select("match", F.col("own").alias("other"), F.col("rarest.word").alias("word"))
    around = asked_words.join(offered, "word").where(F.size(F.array_except("other", "own")) == 0)
    pairs = inside.select("key", "match").unionByName(around.select("key", "match"))
    return pairs.groupBy("key").agg(F.min(_better(F.lit(score), F.col("match"))).alias("within"))


def _noted(names: DataFrame) -> tuple[DataFrame, int]:
    """The names, written, and how many of them are open."""
    noted = Observation()
    names = settled(names.observe(noted, F.count_if(F.col("open")).alias("open")), "names")
    return names, noted.get["open"] or 0


def _keyed(df: DataFrame, text: Column) -> DataFrame:
    return df.withColumn("key", match_key(text)).withColumn("words", word_key(F.col("key")))


def _listed(valid: DataFrame, name: str) -> DataFrame:
    listed = valid.select(F.col(name).alias("match")).na.drop().distinct()
    return _keyed(listed, F.col("match")).filter(F.col("key") != "")


def fuzzy_match(
    names: DataFrame,
    name: str,
    valid: DataFrame,
    threshold: float = 95.0,
    valid_name: str = "name",
    subset_score: float | None = None,
) -> DataFrame:
    """The best valid name of each distinct raw name: (raw, clean, match, score).

    With a ``subset_score`` (``SUBSET_SCORE`` is the usual one) a valid name scores at least so much if all words of one name are among those of the
    other, so ``Tanzania`` finds ``United Republic of Tanzania``; of several the first by the alphabet counts.

    ``match`` and ``score`` are null where no valid name reaches the threshold. Equal names and equal words are found by equi-joins. Names that
    may have a better partner meet, again by an equi-join, first the listed names that are equal to them but for a letter, then, if these leave
    a better one possible, those that share a rare segment near the same place; only these pairs are compared letter by letter. The distinct names are written once, and if none is open nothing more is done.
    """
    spelled = names.select(F.col(name).alias("raw")).na.drop().distinct()
    spelled = _keyed(spelled.withColumn("clean", clean_name("raw")), F.col("clean"))
    listed = _listed(valid, valid_name)
    same_key = listed.groupBy("key").agg(F.min("match").alias("key_match"))
    same_words = listed.groupBy("words").agg(F.min("match").alias("words_match"))
    equal = (
        spelled.join(same_key, "key", "left")
        .join(same_words, "words", "left")
        .withColumn(
            "best",
            F.least(
                _better(F.lit(100.0), F.col("key_match")),
                _better(F.lit(SAME_WORDS_SCORE), F.col("words_match")),
            ),
        )
        .select("raw", "clean", "key", "words", "best")
    )
    if subset_score is not None:
        within = _word_subsets(spelled.select("key", "words").distinct(), listed, subset_score)
        equal = equal.join(within, "key", "left").withColumn("best", F.least("best", "within")).drop("within")
    most = _most_edits(F.col("key"), threshold)
    open_ = (most > 0) & ~F.coalesce(-F.col("best.cost") >= _reachable(F.col("key"), threshold, 1), F.lit(False))
    best, left = _noted(equal.withColumn("open", open_))
    places = int(names.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    steps = [None]
    if left > FEW_NAMES:  # partners one edit away first: variants find them at once, and most names need no others
        steps = [1, None]
    for edits in steps:
        if not left:
            break
        # few bytes, but much work: dealt out by number, which AQE leaves as it is
        keys = best.where("open").select("key").distinct().repartition(places)
        found = _nearest_within(keys, listed, threshold, edits)
        best = best.join(found, "key", "left").withColumn("best", F.least("best", "found")).drop("found")
        beaten = F.coalesce(-F.col("best.cost") >= _reachable(F.col("key"), threshold, 2), F.lit(False))
        still = F.col("open") & (most > 1) & ~beaten if edits else F.lit(False)
        best = best.withColumn("open", still)
        if edits:
            best, left = _noted(best)
    reached = -F.col("best.cost") >= threshold - 1e-9
    return best.select(
        "raw",
        "clean",
        F.when(reached, F.col("best.match")).alias("match"),
        F.when(reached, -F.col("best.cost")).alias("score"),
    )


def _nearest(keys: DataFrame, listed: DataFrame) -> DataFrame:
    """The best listed name, however far, of each of the distinct ``keys`` (key, words): (key, best).

    In a long list, partners from a score of ``NEAR_SCORE`` on are found by segments, and only names without one go to the index.
    """
    size = listed.count()
    same_words = listed.groupBy("words").agg(F.min("match").alias("words_match"))
    best = keys.join(same_words, "words", "left").select("key", _better(F.lit(SAME_WORDS_SCORE), F.col("words_match")).alias("best"))
    if size <= LIST_CHUNK:
        return _closest(best, listed, size).select("key", "best")
    best = settled(best, "names")
    places = int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    near = _nearest_within(best.select("key").repartition(places), listed, NEAR_SCORE)
    best = settled(best.join(near, "key", "left").select("key", F.least("best", "found").alias("best")), "names")
    done = F.coalesce(-F.col("best.cost") >= NEAR_SCORE, F.lit(False))
    return best.where(done).unionByName(_closest(best.where(~done), listed, size).select("key", "best"))


def unmatched_report(matches: DataFrame, valid: DataFrame, valid_name: str = "name") -> DataFrame:
    """The names a ``fuzzy_match`` left unmatched, each with its closest valid name and score."""
    left = matches.filter(F.col("match").isNull()).select("raw", "clean")
    listed = _listed(valid, valid_name)
    left = _keyed(left, F.col("clean"))
    closest = _nearest(left.select("key", "words").distinct(), listed)
    return left.join(closest, "key", "left").select(
        "raw", "clean", F.col("best.match").alias("closest"), (-F.col("best.cost")).alias("score")
    )


def unmatched_count(matches: DataFrame) -> DataFrame:
    """The number of unmatched names."""
    return matches.filter(F.col("match").isNull()).agg(F.countDistinct("clean").alias("unmatched"))


def daily_names(p: Panel) -> DataFrame:
    """Cases and rows per date and raw name: what the matched tables are built from."""
    return p.df.groupBy(p.date, p.entity).agg(*sums(p, [p.cases]), F.count("*").alias("rows"))


def daily_by_matched(p: Panel, daily: DataFrame) -> DataFrame:
    """Cases per date and matched name, in date order; rows without a name are left out."""
    total = f"total_{p.cases}"
    return (
        daily.na.drop(subset=[p.date, "match"])
        .groupBy(p.date, "match")
        .agg(F.sum(total).alias(total))
        .orderBy(p.date, "match")
    )


def coverage(df: DataFrame, match: str = "match", rows: str | None = None) -> DataFrame:
    """Percent of rows with a match, before any grouping; ``rows`` counts pre-summed rows."""
    weight = F.col(rows) if rows else F.lit(1)
    matched = F.sum(F.when(F.col(match).isNotNull(), weight).otherwise(0))
    return df.agg((matched * 100.0 / F.sum(weight)).alias("coverage"))
