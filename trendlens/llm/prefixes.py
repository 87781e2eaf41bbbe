"""Prefix trie of conversations from composable fingerprints.

A sequence of turns has a product in each lane: a power of the lane's base and a sum
``s(x + y) = s(x) * base ** len(y) + s(y)``, modulo a prime. The product of a base
conversation's head and that of a conversation's own suffix combine without rebuilding
texts, and a product without its last turn gives the parent. A node is a group of equal
products; its members must refer to equal stored turns, else other primes are taken.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StructField, StructType

from trendlens.llm.common import SPACE_RUN, batched, stored

#: Longest head that a conversation takes from its base.
HEAD = 3
ENDS = "depth long, nodes array<long>, ids string, first long"


@dataclass(frozen=True)
class Lanes:
    """Primes below 2 ** 31 for each attempt; ``base`` is the base of the first lane."""

    attempts: tuple[tuple[int, ...], ...] = ((2147483647, 2147483629, 2147483587), (2147483579, 2147483563, 2147483549))
    base: int = 1_000_003
    #: ids joined into a stretch before a node's stretches meet
    chunk: int = 256


def _bases(primes: Sequence[int], how: Lanes) -> list[int]:
    return [pow(how.base, k + 1, p) or 1 for k, p in enumerate(primes)]


def running(df: DataFrame, key: str, order: Sequence[str], lanes: Sequence[tuple[int, int | None]], name: str) -> DataFrame:
    """``df`` with ``pos``, a row's place among those of its key by ``order``, and the lanes' products
    up to it: ``m0, s0, m1, s1 ...`` out of the values ``v0, v1 ...``.

    A lane is a base and a prime, or None for plain sums. A hot key lies in many tasks:
    rows are dealt by ranges of key and order, each task adds up its own, and what a
    key has in earlier tasks is added afterwards, one small row for each task.
    """
    values = [f"v{k}" for k in range(len(lanes))]
    sums = [x for k in range(len(lanes)) for x in (f"m{k}", f"s{k}")]
    rest = [c for c in df.columns if c not in values]
    added = StructType([StructField(c, LongType()) for c in ("part", "pos", *sums)] + [StructField("last", BooleanType())])
    schema = StructType([df.schema[c] for c in rest] + added.fields)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        now, pos, state = None, 0, []

        def numbered(batch: pa.RecordBatch) -> list[pa.Array]:
            nonlocal now, pos, state
            found: list[list[int]] = [[] for _ in range(1 + 2 * len(lanes))]
            for who, *row in zip(*[batch.column(c).to_pylist() for c in (key, *values)], strict=True):
                if pos == 0 or who != now:
                    now, pos, state = who, 0, [1, 0] * len(lanes)
                pos += 1
                for k, ((base, prime), value) in enumerate(zip(lanes, row, strict=True)):
                    m, s = state[2 * k] * base, state[2 * k + 1] * base + value
                    state[2 * k], state[2 * k + 1] = (m % prime, s % prime) if prime else (m, s)
                for column, x in zip(found, (pos, *state), strict=True):
                    column.append(x)
            return [pa.array([part] * batch.num_rows, pa.int64()), *[pa.array(c, pa.int64()) for c in found]]

        def whole(batch: pa.RecordBatch, new: list[pa.Array], final: bool) -> pa.RecordBatch:
            last = pa.array([final and k == batch.num_rows - 1 for k in range(batch.num_rows)])
            return pa.RecordBatch.from_arrays([*[batch.column(c) for c in rest], *new, last], names=schema.names)

        held = None
        for batch in batches:
            if batch.num_rows:
                if held:
                    yield whole(*held, False)
                held = batch, numbered(batch)
        if held:
            yield whole(*held, True)

    dealt = df.withColumn("_row", F.monotonically_increasing_id()).repartitionByRange(key, *order, "_row").sortWithinPartitions(key, *order, "_row").drop("_row")
    held = stored(dealt.mapInArrow(walk, schema), name)
    # one row for each task that had rows
    carried, before = [], None
    for end in held.filter("last").select("part", key, "pos", *sums).orderBy("part").collect():
        part, who, pos, *state = end
        if before:
            carried.append((part, *before))
        if before and before[0] == who:
            pos += before[1]
            for k, (_, prime) in enumerate(lanes):
                m, s = before[2 + 2 * k : 4 + 2 * k]
                state[2 * k], state[2 * k + 1] = state[2 * k] * m, s * state[2 * k] + state[2 * k + 1]
                if prime:
                    state[2 * k], state[2 * k + 1] = state[2 * k] % prime, state[2 * k + 1] % prime
        before = (who, pos, *state)
    fields = ["part", key, *[f"c_{c}" for c in ("pos", *sums)]]
    carry = df.sparkSession.createDataFrame(carried, ", ".join(f"{c} long" for c in fields))
    joined = held.drop("last").join(F.broadcast(carry), ["part", key], "left").drop("part")
    columns: dict[str, Column] = {"pos": F.col("pos") + F.coalesce("c_pos", F.lit(0))}
    for k, (_, prime) in enumerate(lanes):
        m, s = F.col(f"m{k}") * F.coalesce(f"c_m{k}", F.lit(1)), F.coalesce(f"c_s{k}", F.lit(0)) * F.col(f"m{k}") + F.col(f"s{k}")
        columns |= {f"m{k}": m % prime if prime else m, f"s{k}": s % prime if prime else s}
    return joined.withColumns(columns).drop(*[f for f in fields if f.startswith("c_")])


def turns(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, the digest that stands for a stored turn's role and text, its words."""
    role, text = F.coalesce(F.col("role"), F.lit("")), F.coalesce(F.col("text"), F.lit(""))
    return conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256)).alias("digest"),
        F.size(F.filter(F.split(text, SPACE_RUN), lambda w: w != "")).cast("long").alias("words"),
    )


def _value(k: int, prime: int) -> Column:
    """A turn's value in lane k."""
    return F.conv(F.substring(F.hex("digest"), 8 * k + 1, 8), 16, 10).cast("long") % (prime - 1) + 1


def rebuilt(conversations: DataFrame, primes: Sequence[int], how: Lanes = Lanes()) -> tuple[DataFrame, DataFrame]:
    """The rebuilt conversations, symbolically: conv_id and ``size``; and one row for each of their
    turns: conv_id, depth, the products ``g0 ...`` up to there, the stored turn (``src``, ``at``:
    conversation and place; ``digest``, ``words``), ``ends`` where the conversation ends.
    """
    lanes = list(enumerate(primes))
    bases = _bases(primes, how)
    rows = turns(conversations).withColumns({f"v{k}": _value(k, p) for k, p in lanes})
    own = running(rows, "conv_id", ["turn", "digest"], list(zip(bases, primes, strict=True)), "turns").drop("turn")
    first = F.struct("pos", *[f"s{k}" for k, _ in lanes], "digest", "words")
    convs = own.groupBy("conv_id").agg(F.max("pos").alias("n"), F.sort_array(F.collect_list(F.when(F.col("pos") <= HEAD, first))).alias("firsts"))
    base = convs.select(F.col("conv_id").alias("base"), F.col("firsts").alias("base_firsts"))
    taken = F.crc32(F.col("conv_id").cast("string").cast("binary")) % (HEAD + 1)
    convs = (
        convs.withColumns({"h": taken, "base": F.col("conv_id") - F.col("conv_id") % 20})
        .join(base, "base", "left")
        .withColumn("head", F.when(F.col("base_firsts").isNull(), F.expr("slice(firsts, 1, 0)")).otherwise(F.expr("slice(base_firsts, 1, int(h))")))
        .withColumns({"n_head": F.size("head").cast("long"), "size": F.size("head") + F.greatest(F.col("n") - F.col("h"), F.lit(0))})
    )
    # what the head's product has instead of the own first turns'
    end = lambda c, at, k: F.coalesce(F.try_element_at(c, at.cast("int"))[f"s{k}"], F.lit(0))
    number = lambda c: F.when(c > 0, c).otherwise(F.lit(100))  # noqa: E731  place 0 has no element
    convs = convs.withColumns({f"d{k}": F.pmod(end("head", number(F.col("n_head")), k) - end("firsts", number(F.col("h")), k), F.lit(p)) for k, p in lanes})
    convs = stored(convs.select("conv_id", "base", "h", "n_head", "size", "head", *[f"d{k}" for k, _ in lanes]), "conversations")
    keep = ["conv_id", "depth", *[f"g{k}" for k, _ in lanes], "src", "at", "digest", "words", "ends"]
    heads = convs.select("conv_id", "size", F.col("base").alias("src"), F.explode("head").alias("t")).select(
        "conv_id", F.col("t.pos").alias("depth"), *[F.col(f"t.s{k}").alias(f"g{k}") for k, _ in lanes], "src", F.col("t.pos").alias("at"), "t.digest", "t.words", (F.col("t.pos") == F.col("size")).alias("ends")
    )
    # base ** (pos - h) as base ** pos over base ** h
    shift = {k: F.element_at(F.array(*[F.lit(pow(b, -h, p)).cast("long") for h in range(HEAD + 1)]), (F.col("h") + 1).cast("int")) for (k, p), b in zip(lanes, bases, strict=True)}
    tails = (
        own.join(convs.drop("head", "base"), "conv_id")
        .filter(F.col("pos") > F.col("h"))
        .withColumns({f"g{k}": (F.col(f"s{k}") + F.col(f"m{k}") * shift[k] % p * F.col(f"d{k}")) % p for k, p in lanes})
        .withColumns({"depth": F.col("pos") - F.col("h") + F.col("n_head"), "src": F.col("conv_id"), "at": F.col("pos")})
        .withColumn("ends", F.col("depth") == F.col("size"))
    )
    return convs.select("conv_id", "size"), stored(heads.unionByName(tails.select(*keep)), "members")


def _grouped(convs: DataFrame, members: DataFrame, primes: Sequence[int], how: Lanes) -> DataFrame:
    """The nodes, the root among them: key, members, smallest member, last turn, the parent's key."""
    lanes = list(enumerate(primes))
    key = ["depth", *[f"g{k}" for k, _ in lanes]]
    nodes = members.groupBy(*key).agg(
        F.count("*").alias("n_convs"),
        F.min("conv_id").alias("conv_id"),
        F.max("words").alias("words"),
        F.min("digest").alias("digest"),
        (F.min("digest") == F.max("digest")).alias("same"),
        F.min(F.struct("src", "at")).alias("turn"),
    )
    less = {f"p{k}": F.pmod(F.col(f"g{k}") - _value(k, p), F.lit(p)) * pow(b, -1, p) % p for (k, p), b in zip(lanes, _bases(primes, how), strict=True)}
    nodes = nodes.withColumns(less).drop("digest")
    root = convs.agg(F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id")).filter("n_convs > 0")
    zero = {c: F.lit(0).cast("long") for c in [*key, "words"]}
    none = {f"p{k}": F.lit(None).cast("long") for k, _ in lanes}
    root = root.withColumns(zero | none | {"same": F.lit(True), "turn": F.lit(None).cast(nodes.schema["turn"].dataType)})
    return stored(nodes.unionByName(root), "nodes")


def ends_digests(ends: DataFrame, key: Sequence[str], chunk: int) -> DataFrame:
    """The key and ``ends_sha256`` of the ids ``conv_id`` of each key, ascending and joined by commas.

    Sorted stretches of a hot key's ids are joined by many tasks; the digest itself reads a
    key's stretches in order, one at a time.
    """
    names = list(key)
    stretches = ", ".join([*[f"{c} long" for c in names], "first long", "ids string"])
    result = ", ".join([*[f"{c} long" for c in names], "ends_sha256 string"])

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            now, ids = None, []
            for batch in batches:
                for *who, conv in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                    if ids and (who != now or len(ids) == chunk):
                        yield (*now, ids[0], ",".join(map(str, ids))), 20 * len(ids)
                        ids = []
                    now = who
                    ids.append(conv)
            if ids:
                yield (*now, ids[0], ",".join(map(str, ids))), 20 * len(ids)

        return batched(rows(), stretches)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            now, state = None, None
            for batch in batches:
                for *who, _, ids in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                    if who == now:
                        state.update(b"," + ids.encode())
                        continue
                    if state:
                        yield (*now, state.hexdigest()), 0
                    now, state = who, hashlib.sha256(ids.encode())
            if state:
                yield (*now, state.hexdigest()), 0

        return batched(rows(), result)

    parts = ends.select(*names, "conv_id").repartitionByRange(*names, "conv_id").sortWithinPartitions(*names, "conv_id").mapInArrow(join, stretches)
    return parts.repartition(*names).sortWithinPartitions(*names, "first").mapInArrow(digest, result)


def trie(conversations: DataFrame, how: Lanes = Lanes()) -> DataFrame:
    """One row for each distinct beginning of the rebuilt conversations, the empty one included.

    A conversation is rebuilt from the first h turns of the one whose id is its own less
    the remainder by 20 (none if that is absent) and its own turns after the first h, with
    h the crc32 of its id modulo 4. conv_id is a node's smallest member; last_conv_id and
    last_place tell where its last turn is stored (NULL for the root).

    Turns go by number, NULL first, and by a digest of role and text within one number; a
    NULL role or text is empty, and repeated rows are turns of their own. Rows without
    conv_id belong to no conversation. Other columns are ignored. An empty table has no
    node. A long conversation and a node with many members lie in many tasks; the depth
    of the trie adds no rounds.
    """
    for primes in how.attempts:
        convs, members = rebuilt(conversations, primes, how)
        nodes = _grouped(convs, members, primes, how)
        if nodes.filter("NOT same").isEmpty():
            break
    else:
        raise ValueError("different turns have equal products in every attempt; give Lanes more primes")
    lanes = range(len(primes))
    key, parent = ["depth", *[f"g{k}" for k in lanes]], [f"p{k}" for k in lanes]
    above = lambda df: df.select((F.col("depth") - 1).alias("depth"), *[F.col(p).alias(g) for p, g in zip(parent, key[1:], strict=True)])
    children = above(nodes.filter("depth > 0")).groupBy(*key).agg(F.count("*").alias("n_children"))
    nodes = nodes.join(children, key, "left").withColumns({"n_children": F.coalesce("n_children", F.lit(0)), "own": (F.col("n_convs") - 1) * F.col("words")})
    nodes = stored(nodes, "linked_nodes")
    # A node's smallest member is that of its nodes below along the same conversation, so
    # each conversation owns one chain of nodes. A subtree is the chains of its members,
    # its smallest member's without the part above.
    chains = nodes.groupBy("conv_id").agg(F.sum("own").alias("saved"), F.sum((F.col("n_children") == 0).cast("long")).alias("leaves"))
    chains = stored(chains.filter("saved > 0 OR leaves > 0"), "chains")
    sums = [F.sum("saved").alias("saved"), F.sum("leaves").alias("n_leaves")]
    below = members.select("conv_id", *key).join(chains, "conv_id").groupBy(*key).agg(*sums)
    zero = [F.lit(0).cast("long").alias(c) for c in key]
    below = below.unionByName(chains.agg(*sums).filter("n_leaves > 0").select(*zero, "saved", "n_leaves"))
    # what a chain saves above a node; a node of one member saves nothing, nor does what is below it
    shared = nodes.filter("n_convs > 1").select("conv_id", *key, F.col("own").alias("v0"))
    upto = running(shared, "conv_id", ["depth"], [(1, None)], "shared").select("conv_id", "depth", F.col("s0").alias("upto"))
    ends = members.filter("ends").select(*key, "conv_id").unionByName(convs.filter("size = 0").select(*zero, "conv_id"))
    names = nodes.select(*[F.col(c).alias(f"up_{c}") for c in key], F.col("conv_id").alias("parent_conv_id"))
    up = F.col("depth") - 1 == F.col("up_depth")
    for p, g in zip(parent, key[1:], strict=True):
        up = up & (F.col(p) == F.col(f"up_{g}"))
    joined = (
        nodes.join(below, key, "left")
        .join(ends_digests(ends, key, how.chunk), key, "left")
        .join(names, up, "left")
        .join(upto, ["conv_id", "depth"], "left")
    )
    return joined.select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        "n_children",
        "n_leaves",
        F.coalesce(F.col("saved") - (F.col("upto") - F.col("own")), F.lit(0)).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
        F.col("turn.src").alias("last_conv_id"),
        F.col("turn.at").alias("last_place"),
    )
