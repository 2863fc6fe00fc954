"""MinHash near-duplicates with bottom-k sketches from one hash (operator 5).

1. Each text becomes its set of five-word shingle hashes; equal sets are one
   class, with a number of its own (``rep``), before anything is compared; its text
   is that of its least (doc_id, text key). The sketch of a set is its ``k``
   smallest hashes. Numbers, not ids, meet from here on, so an id that names
   several texts joins nothing that its texts do not.
2. Inverted lists: two sets with Jaccard similarity ``t`` share at least ``m`` of
   their retained values (all but one pair in 10^9, by the binomial tail of the
   union's sketch, or surely where the sketch is the whole set). So it suffices to
   index, of each sketch, the ``k - m + 1`` values with the *shortest* lists:
   values that occur once cost nothing, and a passage that very many documents
   share falls out of the index unless it is most of the sketch.
3. Candidates are links to the *hub* of a list, its member with the longest
   lists (in a group of near copies, the text they came from), so a group of any
   size gives a number of candidates in proportion to it. Members of a hub that
   end up outside its largest component then meet all its members, in chunks, and
   are compared inside the meeting: it returns links, never its pairs.
4. The union's sketch, merged from two sketches, estimates the similarity and
   drops hopeless candidates; the others are decided on the full sets.
5. Components of the links by large and small stars.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inforce.llm.common import batch_of, release_tables, shingle_sets, spare, text_pieces, texts_of, written
from inforce.llm.components import connected_components

SKETCH, WORDS = 32, 5
#: Chance that a pair at the threshold shares fewer retained values than asked.
MISS = 1e-9
#: A candidate's estimate may fall this much short of the threshold (over 5 sigma at k = 32).
SLACK = 0.4
#: Texts and shingles of a chunk of a meeting.
CHUNK_TEXTS, CHUNK_SHINGLES = 512, 500_000

#: Ways in which a hub's members are dealt when they are joined with its sizes.
SALTS = 16

_SKETCH_ARROW = pa.schema([("doc_id", pa.int64()), ("text_key", pa.binary()), ("n_shingles", pa.int64()), ("set_key", pa.binary()), ("sketch", pa.list_(pa.int64()))])
_LINK_ARROW = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("shared", pa.int64()), ("joint", pa.int64())])


def least_overlap(k: int, threshold: float, miss: float = MISS) -> int:
    """The largest m with P(Binomial(k, threshold) < m) at most ``miss``."""
    total, m = 0.0, 0
    while m < k:
        total += math.comb(k, m) * threshold**m * (1 - threshold) ** (k - m)
        if total > miss:
            break
        m += 1
    return max(1, m)


def text_key() -> Column:
    """A 256-bit key of ``text``."""
    return F.unhex(F.sha2(F.col("text").cast("binary"), 256))


def sketches(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = SKETCH, words: int = WORDS) -> DataFrame:
    """doc_id, a key of the text, n_shingles, a 128-bit key of the set, and its k
    smallest hashes (as unsigned order mapped to signed longs)."""

    def run(batches):
        release_tables()
        for b in batches:
            done = 0
            for ids, texts in text_pieces([b]):
                sets = list(shingle_sets(texts, words))
                keys = b.column(2).slice(done, len(texts))
                done += len(texts)
                yield batch_of(_SKETCH_ARROW, doc_id=ids, text_key=keys, n_shingles=[s.size for s in sets], set_key=[hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], sketch=[(s[:k] ^ np.uint64(1 << 63)).view(np.int64) for s in sets])

    return texts_of(docs, id_col, text_col).select("doc_id", "text", text_key().alias("text_key")).mapInArrow(run, "doc_id long, text_key binary, n_shingles long, set_key binary, sketch array<long>")


def indexed_values(reps: DataFrame, k: int, threshold: float) -> DataFrame:
    """(value, rep, n, typical) of the rarest values of each representative's
    sketch that any other one retains too; typical: the lengths of all its lists."""
    m = least_overlap(k, threshold)
    # from this size on the partner's sketch may be cut, so m holds; below, sketches are whole sets
    whole = math.ceil(threshold * (k + 1))
    n, size = F.col("n"), F.size("sketch")
    asked = F.when(n >= whole, F.lit(m)).otherwise(F.ceil(n * threshold - 1e-9))
    values = reps.select("rep", "n", (size - asked + 1).alias("room"), size.alias("kept"), F.explode("sketch").alias("value"))
    lists = values.groupBy("value").agg(F.count("*").alias("df")).filter(F.col("df") > 1)
    shared = values.join(lists, "value").groupBy("rep", "n", "room", "kept").agg(F.sort_array(F.collect_list(F.struct("df", "value"))).alias("found"), F.sum("df").alias("typical"))
    room = (F.col("room") - (F.col("kept") - F.size("found"))).cast("int")
    return shared.filter(room > 0).select("rep", "n", "typical", F.explode(F.slice("found", F.lit(1), room)).alias("x")).select(F.col("x.value").alias("value"), "rep", "n", "typical")


def hub_members(lists: DataFrame) -> DataFrame:
    """(hub, hub_n, rep, n): every representative with the hubs of its lists."""
    hubs = lists.groupBy("value").agg(F.max(F.struct("typical", (-F.col("rep")).alias("minus"), "n")).alias("h")).select("value", (-F.col("h.minus")).alias("hub"), F.col("h.n").alias("hub_n"))
    return lists.join(hubs, "value").filter(F.col("rep") != F.col("hub")).select("hub", "hub_n", "rep", "n").distinct()


def mixed_meetings(members: DataFrame, component: DataFrame) -> DataFrame:
    """(hub, lo, hi, rep, chunk, component): the members of each hub that has more
    than one component, in chunks that meet in pairs, so that a meeting holds at
    most about 2 * CHUNK_TEXTS texts and 2 * CHUNK_SHINGLES shingles. Members of the
    hub's largest component are linked already: they meet the other members'
    chunks, not each other's."""
    known = members.join(component.withColumnRenamed("node", "rep"), "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    parts = known.groupBy("hub", "component").agg(F.count("*").alias("texts"), F.sum("n").alias("shingles"))
    sizes = parts.groupBy("hub").agg(F.max(F.struct("texts", "shingles", "component")).alias("main"), F.sum("texts").alias("texts"), F.sum("shingles").alias("shingles")).filter(F.col("texts") > F.col("main.texts"))

    def chunks(texts: Column, shingles: Column) -> Column:
        return F.greatest(F.ceil(texts / CHUNK_TEXTS), F.ceil(shingles / CHUNK_SHINGLES)).cast("int")

    main, other = chunks(F.col("main.texts"), F.col("main.shingles")), chunks(F.col("texts") - F.col("main.texts"), F.col("shingles") - F.col("main.shingles"))
    sizes = sizes.select("hub", F.col("main.component").alias("main"), main.alias("mains"), other.alias("others"))
    # a hub may hold a large share of all members: they are dealt by a salt as well
    sizes = sizes.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    known = known.withColumn("salt", F.pmod(F.xxhash64("rep"), F.lit(SALTS)).cast("int")).join(sizes, ["hub", "salt"])
    inside = F.col("component") == F.col("main")
    own = F.xxhash64("rep", F.lit("chunk"))
    known = known.withColumn("chunk", F.when(inside, F.pmod(own, F.col("mains"))).otherwise(F.col("mains") + F.pmod(own, F.col("others"))).cast("int"))
    last = F.col("mains") + F.col("others") - 1
    known = known.withColumn("with", F.explode(F.sequence(F.when(inside, F.col("mains")).otherwise(F.lit(0)), last)))
    return known.select("hub", F.least("chunk", "with").alias("lo"), F.greatest("chunk", "with").alias("hi"), "rep", "chunk", "component")


def fingerprints(sets: list[np.ndarray]) -> np.ndarray:
    """One row per set: 16 bits of the smallest hash in each of 256 ranges of the
    hash's values; 0 where a range is empty."""
    out = np.zeros((len(sets), 256), dtype=np.uint16)
    for i, s in enumerate(sets):
        bins = (s >> np.uint64(56)).astype(np.int64)
        first = np.concatenate([[True], bins[1:] != bins[:-1]]) if s.size else np.zeros(0, bool)
        out[i, bins[first]] = ((s[first] >> np.uint64(40)) & np.uint64(0xFFFF)).astype(np.uint16) | 1
    return out


def links_between(rep: list[int], chunk: list[int], component: list[int], sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links found in a meeting, enough to join all that its links join. Pairs
    of one component are skipped, as are sizes that rule a link out and pairs whose
    fingerprints agree in far fewer ranges than a link's would (over 5 sigma);
    all others are decided on the full sets."""
    t = percent / 100
    size = np.array([s.size for s in sets])
    prints = fingerprints(sets)
    filled = prints > 0
    sides = np.asarray(chunk)
    across = len(set(chunk)) > 1
    root = {c: c for c in component}

    def find(c: int) -> int:
        while root[c] != c:
            root[c] = root[root[c]]
            c = root[c]
        return c

    links = []
    for i in range(len(rep) - 1):
        rest = slice(i + 1, None)
        fit = np.minimum(size[i], size[rest]) >= np.maximum(size[i], size[rest]) * t - 1e-9
        if across:
            fit &= sides[rest] != sides[i]
        at = np.flatnonzero(fit) + i + 1
        if at.size == 0:
            continue
        ranges = (filled[i] | filled[at]).sum(axis=1)
        same = ((prints[i] == prints[at]) & filled[i]).sum(axis=1)
        at = at[same >= ranges * t - 5.5 * np.sqrt(ranges * t * (1 - t)) - 1]
        for j in at.tolist():
            a, b = find(component[i]), find(component[j])
            if a == b:
                continue
            pos = np.minimum(np.searchsorted(sets[j], sets[i]), sets[j].size - 1)
            shared = int((sets[j][pos] == sets[i]).sum())
            if 100 * shared >= percent * int(size[i] + size[j] - shared):
                root[max(a, b)] = min(a, b)
                links.append((rep[i], rep[j]))
    return links


def links_of_meetings(meetings: DataFrame, texts: DataFrame, percent: int, words: int) -> DataFrame:
    """(a, b) found in the meetings; one meeting's texts are held at a time."""
    out = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches):
        held: list[pa.RecordBatch] = []
        last = None

        def close():
            t = pa.Table.from_batches(held)
            rep, chunk, component, texts = (t.column(c).to_pylist() for c in ("rep", "chunk", "component", "text"))
            found = links_between(rep, chunk, component, list(shingle_sets(texts, words)), percent)
            return batch_of(out, a=[a for a, _ in found], b=[b for _, b in found])

        for b in batches:
            if b.num_rows == 0:
                continue
            k = [b.column(i).to_numpy() for i in range(3)]
            cut = np.flatnonzero((np.diff(k[0]) != 0) | (np.diff(k[1]) != 0) | (np.diff(k[2]) != 0)) + 1
            for i, j in zip([0, *cut], [*cut, b.num_rows], strict=True):
                key = tuple(int(c[i]) for c in k)
                if key != last and held:
                    yield close()
                    held = []
                last = key
                held.append(b.slice(i, j - i))
        if held:
            yield close()

    tasks = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = meetings.join(texts, "rep").select("hub", "lo", "hi", "rep", "chunk", "component", "text")
    return rows.repartition(tasks, "hub", "lo", "hi").sortWithinPartitions("hub", "lo", "hi").mapInArrow(run, "a long, b long")


def _sizes_allow(n: Column, other: Column, threshold: float) -> Column:
    return F.least(n, other) >= F.greatest(n, other) * threshold - 1e-9


def estimated(pairs: DataFrame, reps: DataFrame, k: int, threshold: float) -> DataFrame:
    """Pairs whose union sketch does not rule the threshold out."""
    one = reps.select(F.col("rep").alias("a"), F.col("sketch").alias("sa"))
    other = reps.select(F.col("rep").alias("b"), F.col("sketch").alias("sb"))
    union = F.slice(F.array_sort(F.array_union("sa", "sb")), 1, k)
    both = F.size(F.array_intersect(F.array_intersect("sa", "sb"), union))
    return pairs.join(one, "a").join(other, "b").filter(both >= F.size(union) * (threshold - SLACK)).select("a", "b")


def class_texts(reps: DataFrame, docs: DataFrame) -> DataFrame:
    """(rep, text): the text of each class in ``reps`` (rep, doc_id, text_key)."""
    rows = docs.withColumn("text_key", text_key()).join(reps.select("rep", "doc_id", "text_key"), ["doc_id", "text_key"])
    # rows that repeat id and text; combined before the shuffle
    return rows.groupBy("rep").agg(F.first("text").alias("text"))


def verified(pairs: DataFrame, texts: DataFrame, percent: int, words: int = WORDS) -> DataFrame:
    """The pairs with 100 * intersection >= percent * union on the full sets,
    which are made from the whole texts again (only those of candidates move)."""

    def run(batches):
        release_tables()
        last = {}  # pairs arrive sorted by b, the hub of many
        for batch in batches:
            a, b = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            ta, tb = batch.column(2), batch.column(3)
            shared, joint = np.zeros(len(a), np.int64), np.zeros(len(a), np.int64)
            for i, own in enumerate(shingle_sets([x.as_py() for x in ta], words)):
                if b[i] not in last:
                    last = {b[i]: next(shingle_sets([tb[i].as_py()], words))}
                hub = last[b[i]]
                shared[i] = np.intersect1d(own, hub, assume_unique=True).size
                joint[i] = own.size + hub.size - shared[i]
            yield batch_of(_LINK_ARROW, a=a, b=b, shared=shared, joint=joint).filter(pa.array(100 * shared >= percent * joint))

    one = texts.select(F.col("rep").alias("a"), F.col("text").alias("ta"))
    other = texts.select(F.col("rep").alias("b"), F.col("text").alias("tb"))
    return pairs.join(one, "a").join(other, "b").select("a", "b", "ta", "tb").mapInArrow(run, "a long, b long, shared long, joint long")


def duplicate_rows(docs: DataFrame, percent: int = 80, id_col: str = "doc_id", text_col: str = "text", k: int = SKETCH, words: int = WORDS) -> DataFrame:
    """One row per input row: doc_id, text_key, n_shingles, component_id (least
    doc_id reachable) and first_key, the key of the least text under that id in the
    component (null where a row has no shingles or a null id)."""
    threshold = percent / 100
    base = texts_of(docs, id_col, text_col)
    made = written(sketches(base, k=k, words=words), "sketches")
    usable = made.filter((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull())
    least = usable.groupBy("set_key").agg(F.min(F.struct("doc_id", "text_key")).alias("least"), F.first("n_shingles").alias("n"), F.first("sketch").alias("sketch"))
    # written with its numbers, so they stay what they are
    classes = written(least.select(F.monotonically_increasing_id().alias("rep"), "set_key", F.col("least.doc_id").alias("doc_id"), F.col("least.text_key").alias("text_key"), "n", "sketch"), "representatives")
    reps = classes.select("rep", "n", "sketch")
    lists = written(indexed_values(reps, k, threshold), "lists")
    members = written(hub_members(lists), "members")
    pairs = members.filter(_sizes_allow(F.col("n"), F.col("hub_n"), threshold)).select(F.col("rep").alias("a"), F.col("hub").alias("b"))
    pairs = written(estimated(pairs, reps, k, threshold), "candidates")
    asked = pairs.select(F.explode(F.array("a", "b")).alias("rep")).distinct()
    # written: both joins read it, and Spark can split a join on a hub of very many pairs
    texts = written(class_texts(classes.join(asked, "rep"), base), "candidate-texts")
    links = written(verified(pairs, texts, percent, words).select("a", "b"), "verified")
    component = connected_components(links)
    meetings = written(mixed_meetings(members, component), "meetings")
    asked = meetings.select("rep").distinct()
    texts = written(class_texts(classes.join(asked, "rep"), base), "met-texts")
    more = written(links_of_meetings(meetings, texts, percent, words), "met")
    if not more.isEmpty():
        component = connected_components(links.unionAll(more))
    of_class = classes.join(component.withColumnRenamed("node", "rep"), "rep", "left").select("set_key", "doc_id", "text_key", F.coalesce("component", "rep").alias("component"))
    first = of_class.groupBy("component").agg(F.min(F.struct("doc_id", "text_key")).alias("first"))
    of_class = of_class.join(first, "component").select("set_key", F.col("first.doc_id").alias("component_id"), F.col("first.text_key").alias("first_key"))
    key = F.when((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), F.col("set_key"))
    joined = made.select("doc_id", "text_key", "n_shingles", key.alias("set_key")).join(of_class, "set_key", "left")
    return joined.select("doc_id", "text_key", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"), "first_key")


def near_duplicates(docs: DataFrame, percent: int = 80, id_col: str = "doc_id", text_col: str = "text", k: int = SKETCH, words: int = WORDS) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id, kept.

    Rows are linked when 100 * intersection >= percent * union of their shingle
    sets; component_id is the smallest doc_id reachable. Null texts and texts
    without words have no shingles and are linked with nothing, as are rows with
    a null doc_id (component_id null, kept false). A text of fewer than ``words``
    words is one shingle. Rows are linked by their texts alone: where an id occurs
    with different texts, each of its rows has the component of its own text, and
    kept says that the row's id is the component's. An empty table gives an empty
    result; extra columns are not read.
    """
    rows = duplicate_rows(docs, percent, id_col, text_col, k, words)
    return rows.select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)).alias("kept"))


def without_near_duplicates(docs: DataFrame, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group of linked rows: that with the least id
    and, under one id, the least key of its text; of rows that repeat both, any
    one. Rows that are linked with nothing (no words, a null id) all stay."""
    found = written(duplicate_rows(docs, percent, id_col, text_col), "near-duplicates").filter(F.col("first_key").isNotNull())
    first = (F.col("doc_id") == F.col("component_id")) & (F.col("text_key") == F.col("first_key"))
    names = on = [spare(docs.columns, "row_id"), spare(docs.columns, "row_key")]
    as_names = [F.col("doc_id").alias(names[0]), F.col("text_key").alias(names[1])]
    gone = found.filter(~first).select(as_names).distinct()
    keyed = docs.select("*", F.col(id_col).cast("long").alias(names[0]), F.unhex(F.sha2(F.coalesce(F.col(text_col), F.lit("")).cast("binary"), 256)).alias(names[1]))
    left = keyed.join(gone, on, "left_anti")
    repeated = written(found.filter(first).groupBy(as_names).count().filter("count > 1").select(on), "repeated-rows")
    if repeated.isEmpty():
        return left.select(docs.columns)
    once = left.join(repeated, on, "left_semi").dropDuplicates(on)
    return left.join(repeated, on, "left_anti").select(docs.columns).unionByName(once.select(docs.columns))
