"""Sets of transactions per server, as half-open intervals of their numbers: gaps-and-islands over DataFrames, and the
same algebra on small sets held in an object."""

from __future__ import annotations

import re
import struct
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidelog.operators.ordered import laid_out, running

#: Numbers of a stretch.
STRETCH = 65_536


def coalesced(df: DataFrame, server: str = "sid", start: str = "start", end: str = "end") -> DataFrame:
    """The union of intervals [start, end) per server: overlapping and adjacent ones become one.

    Intervals are joined inside stretches of numbers first, which leaves few of them where numbers are dense; a server
    with very many is then still run along in parts (operators.ordered).
    """
    near = df.select(server, start, end).distinct().withColumn("_stretch", F.expr(f"`{start}` div {STRETCH}"))
    by = Window.partitionBy(server, "_stretch").orderBy(start, end)
    reach = F.max(end).over(by.rowsBetween(Window.unboundedPreceding, -1))
    first = F.when(reach.isNull() | (F.col(start) > reach), 1).otherwise(0)
    islands = near.withColumn("_new", first).withColumn("_island", F.sum("_new").over(by))
    joined = islands.groupBy(server, "_stretch", "_island").agg(F.min(start).alias(start), F.max(end).alias(end)).select(server, start, end)
    laid = laid_out(joined, [server], [start, end])
    reached = running(laid, [server], [start, end], "_reach", F.col(end), "max", inclusive=False)
    new = F.when(F.col("_reach").isNull() | (F.col(start) > F.col("_reach")), 1).otherwise(0)
    numbered = running(reached, [server], [start, end], "_island", new, "sum")
    return numbered.groupBy(server, "_island").agg(F.min(start).alias(start), F.max(end).alias(end)).drop("_island")


def intervals(df: DataFrame, server: str, number: str) -> DataFrame:
    """Single numbers as the intervals they form."""
    return coalesced(df.select(F.col(server).alias("sid"), F.col(number).alias("start"), (F.col(number) + 1).alias("end")))


def subtracted(a: DataFrame, b: DataFrame) -> DataFrame:
    """What a covers and b doesn't, both with sid, start, end.

    Every edge changes how many intervals of a and b are open; stretches where a is and b isn't are kept. One sort per
    server, no comparison of intervals with each other.
    """
    edge = lambda df, who: df.select("sid", F.col("start").alias("at"), F.lit(1).alias("by"), F.lit(who).alias("who")).unionByName(
        df.select("sid", F.col("end").alias("at"), F.lit(-1).alias("by"), F.lit(who).alias("who"))
    )
    edges = edge(a, "a").unionByName(edge(b, "b")).groupBy("sid", "at").agg(
        F.sum(F.when(F.col("who") == "a", F.col("by")).otherwise(0)).alias("da"), F.sum(F.when(F.col("who") == "b", F.col("by")).otherwise(0)).alias("db")
    )
    # Numbered from the highest edge down, so that the edge after each is the last one met.
    down = edges.withColumn("_down", -F.col("at"))
    down = running(laid_out(down, ["sid"], ["_down"]), ["sid"], ["_down"], "end", F.col("at"), "last", inclusive=False).drop("_part")
    up = laid_out(down, ["sid"], ["at"])
    up = running(running(up, ["sid"], ["at"], "in_a", F.col("da"), "sum"), ["sid"], ["at"], "in_b", F.col("db"), "sum")
    return coalesced(up.where("in_a > 0 AND in_b = 0").select("sid", F.col("at").alias("start"), "end"))


def contained(a: DataFrame, b: DataFrame) -> DataFrame:
    """sid of the servers of b whose intervals all lie in a's."""
    rest = subtracted(b, a).select("sid").distinct()
    return b.select("sid").distinct().join(rest, "sid", "left_anti")


_SID = re.compile(r"[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}")


def _merged(parts: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for lo, hi in sorted(parts):
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(hi, out[-1][1]))
        else:
            out.append((lo, hi))
    return out


@dataclass
class GtidSet:
    """Transactions by server: half-open intervals, sorted, apart from each other."""

    servers: dict[str, list[tuple[int, int]]] = field(default_factory=dict)

    @staticmethod
    def parse(text: str) -> GtidSet:
        """From 'sid:1-5:7, sid:3'. Raises ValueError for anything malformed."""
        out = GtidSet()
        for part in filter(None, (p.strip() for p in text.replace("\n", "").split(","))):
            sid, *spans = (x.strip() for x in part.split(":"))
            if not _SID.fullmatch(sid) or not spans:
                raise ValueError(f"not a transaction set: {part!r}")
            for span in spans:
                m = re.fullmatch(r"(\d+)(?:-(\d+))?", span)
                if not m or int(m[1]) < 1 or m[2] and int(m[2]) < int(m[1]):
                    raise ValueError(f"not an interval: {span!r}")
                out = out + GtidSet({sid.lower(): [(int(m[1]), int(m[2] or m[1]) + 1)]})
        return out

    def __add__(self, other: GtidSet) -> GtidSet:
        sids = [*self.servers, *(s for s in other.servers if s not in self.servers)]
        return GtidSet({s: _merged(self.servers.get(s, []) + other.servers.get(s, [])) for s in sids})

    def __sub__(self, other: GtidSet) -> GtidSet:
        out = {}
        for sid, spans in self.servers.items():
            rest = list(spans)
            for lo, hi in other.servers.get(sid, []):
                rest = [x for a, b in rest for x in ((a, min(b, lo)), (max(a, hi), b)) if x[0] < x[1]]
            if rest:
                out[sid] = rest
        return GtidSet(out)

    def __contains__(self, other: GtidSet) -> bool:
        return not (other - self).servers

    def __le__(self, other: GtidSet) -> bool:
        """Whether the other holds all of it; sets that hold transactions the other lacks are neither below nor above."""
        return self in other

    def __lt__(self, other: GtidSet) -> bool:
        return self in other and self.servers != other.servers

    def overlaps(self, other: GtidSet) -> bool:
        """Whether any transaction is in both."""
        return any(a < d and c < b for sid, spans in self.servers.items() for a, b in spans for c, d in other.servers.get(sid, []))

    def __len__(self) -> int:
        return sum(b - a for spans in self.servers.values() for a, b in spans)

    def __bool__(self) -> bool:
        return bool(self.servers)

    def __str__(self) -> str:
        span = lambda lo, hi: str(lo) if hi == lo + 1 else f"{lo}-{hi - 1}"
        return ",".join(sid + "".join(":" + span(*x) for x in spans) for sid, spans in sorted(self.servers.items()))

    def encode(self) -> bytes:
        """The log's binary form: counts and bounds as little-endian 8-byte numbers, ends exclusive."""
        out = struct.pack("<Q", len(self.servers))
        for sid, spans in sorted(self.servers.items()):
            out += uuid.UUID(sid).bytes + struct.pack("<Q", len(spans)) + b"".join(struct.pack("<QQ", *x) for x in spans)
        return out

    @staticmethod
    def decode(data: bytes) -> GtidSet:
        (n,), at, out = struct.unpack_from("<Q", data), 8, {}
        for _ in range(n):
            sid, (m,) = str(uuid.UUID(bytes=data[at : at + 16])), struct.unpack_from("<Q", data, at + 16)
            at += 24
            out[sid] = [struct.unpack_from("<QQ", data, at + 16 * i) for i in range(m)]
            at += 16 * m
        return GtidSet(out)
