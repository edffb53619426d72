"""Traffic: routes, networks, sliding rates, blocks, and scaling decisions."""

from __future__ import annotations

import ipaddress
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Category:
    name: str
    prefixes: tuple[str, ...]  # of "METHOD /path"
    per_client: int
    total: int


@dataclass(frozen=True)
class Profile:
    categories: tuple[Category, ...]
    default: Category
    window_seconds: int = 60
    block_seconds: int = 300
    allowlist: tuple[str, ...] = ()

    def category(self, method: Column, path: Column) -> Column:
        """Name of the first category that a request's method and path begin like."""
        probe, out = F.concat_ws(" ", F.upper(method), path), F.lit(None).cast("string")
        for c in reversed(self.categories):
            for p in c.prefixes:
                out = F.when(probe.startswith(p), F.lit(c.name)).otherwise(out)
        return F.coalesce(out, F.lit(self.default.name))

    def limits(self, spark: SparkSession) -> DataFrame:
        rows = [(c.name, c.per_client, c.total) for c in (*self.categories, self.default)]
        return spark.createDataFrame(rows, "category string, per_client long, total long")


def by_prefix(rows: DataFrame, probe: Column, table: DataFrame, broadcast_rows: int = 100_000) -> DataFrame:
    """``rows`` with value: that of the least rank among the entries of ``table`` (prefix, rank, value) that ``probe`` begins with; null if none.

    One join on equality for each length in use, of which there are few; no row is numbered and none leaves its
    task where the table has at most ``broadcast_rows`` prefixes. A larger one is left to Spark's own choice of join.
    Entries with a null prefix match nothing.
    """
    best = table.where("prefix is not null").groupBy("prefix").agg(F.min(F.struct("rank", "value")).alias("hit")).withColumn("size", F.length("prefix"))
    sizes = {r["size"]: r["n"] for r in best.groupBy("size").agg(F.count("*").alias("n")).collect()}  # a row for each length
    small = sum(sizes.values()) <= broadcast_rows
    own, out = rows.columns, rows.withColumn("__probe", probe)
    for n in sorted(sizes):
        part = best.where(F.col("size") == n).select(F.col("prefix").alias(f"__p{n}"), F.col("hit").alias(f"__h{n}"))
        out = out.join(F.broadcast(part) if small else part, F.left("__probe", F.lit(n)) == F.col(f"__p{n}"), "left")
    hits = F.array_compact(F.array(*(F.col(f"__h{n}") for n in sizes))) if sizes else F.lit(None)
    return out.select(*own, (F.array_min(hits)["value"] if sizes else hits.cast("string")).alias("value"))


def route(requests: DataFrame, rules: DataFrame, default: str = "default") -> DataFrame:
    """Each request with the category of its first matching rule; ``rules`` (rule_no, prefix, category) of any number."""
    table = rules.select("prefix", F.col("rule_no").alias("rank"), F.col("category").alias("value"))
    found = by_prefix(requests, F.concat_ws(" ", F.upper("method"), F.col("path")), table)
    return found.withColumn("category", F.coalesce("value", F.lit(default))).drop("value")


def ip_number(ip: Column) -> Column:
    """IPv4 address as a number; null for anything else."""
    parts = F.split(ip, r"\.")
    value = sum((parts[i].cast("long") * (1 << (24 - 8 * i)) for i in range(4)), F.lit(0).cast("long"))
    octet = r"(25[0-5]|2[0-4]\d|1?\d?\d)"
    return F.when(ip.rlike(rf"^{octet}(\.{octet}){{3}}$"), value)


def address_bits(ip: Column) -> Column:
    """The bits of an address as text, after 4: or 6: for its kind; null for what is no address.

    An IPv6 address may have one :: and may end in an IPv4 address.
    """
    four = F.concat(F.lit("4:"), F.lpad(F.bin(ip_number(ip)), 32, "0"))
    tail = ip_number(F.substring_index(ip, ":", -1))
    low = F.concat_ws(":", F.lower(F.hex(F.shiftright(tail, 16))), F.lower(F.hex(tail.bitwiseAND(0xFFFF))))
    text = F.lower(F.when(tail.isNotNull(), F.concat(F.regexp_extract(ip, "^(.*:)[^:]*$", 1), low)).otherwise(ip))
    halves = F.split(text, "::")
    groups = [F.filter(F.split(F.coalesce(F.get(halves, F.lit(i)), F.lit("")), ":"), lambda g: g != "") for i in range(2)]
    missing = F.lit(8) - F.size(groups[0]) - F.size(groups[1])
    whole = F.concat(groups[0], F.array_repeat(F.lit("0"), F.greatest(missing, F.lit(0))), groups[1])
    group = "[0-9a-f]{1,4}"
    plain = text.rlike(rf"^{group}(:{group}){{7}}$")
    short = text.rlike(rf"^({group}(:{group})*)?::({group}(:{group})*)?$") & (missing >= 1)
    bits = F.array_join(F.transform(whole, lambda g: F.lpad(F.conv(g, 16, 2), 16, "0")), "")
    return F.coalesce(four, F.when(plain | short, F.concat(F.lit("6:"), bits)))


def _network_bits(cidr: str) -> tuple[str, int, str]:
    n = ipaddress.ip_network(cidr, strict=False)
    return str(n), n.prefixlen, f"{n.version}:" + f"{int(n.network_address):0{n.max_prefixlen}b}"[:n.prefixlen]


def networks(spark: SparkSession, cidrs: list[str]) -> DataFrame:
    """network, bits, prefix (the network's bits, as in :func:`address_bits`) of IPv4 and IPv6 networks in CIDR form."""
    return spark.createDataFrame([_network_bits(c) for c in cidrs], "network string, bits int, prefix string")


def in_networks(df: DataFrame, ip: str, nets: DataFrame) -> DataFrame:
    """The rows with the narrowest network that holds their address, or null; joins on equality of leading bits, so no range join."""
    table = nets.select("prefix", (-F.col("bits")).alias("rank"), F.col("network").alias("value"))
    return by_prefix(df, address_bits(F.col(ip)), table).withColumnRenamed("value", "network")


def is_listed(ip: Column, cidrs: list[str]) -> Column:
    """Whether an address is in one of a short list of networks; false for what is no address."""
    bits, out = address_bits(ip), F.lit(False)
    for c in cidrs:
        out |= bits.startswith(_network_bits(c)[2])
    return F.coalesce(out, F.lit(False))


def client_address(forwarded: Column, peer: Column) -> Column:
    """The first hop of a forwarding header, else the peer."""
    return F.coalesce(F.nullif(F.trim(F.split(forwarded, ",")[0]), F.lit("")), peer)


def sliding_rates(requests: DataFrame, seconds: int = 60) -> DataFrame:
    """Each request with the hits of its client in its category, and of its category, in the trailing window, itself included.

    ``requests`` (client, category, ts). The window's far end is inclusive.
    """
    return _trailing(_trailing(requests, ("category", "client"), "client_hits", seconds), ("category",), "category_hits", seconds)


def _trailing(requests: DataFrame, by: tuple[str, ...], name: str, seconds: int) -> DataFrame:
    """Adds the number of rows of the same keys in the trailing window. One key may hold most rows, so its rows are cut
    into slots of a window's length: a row's window is its own slot up to it and the slot before from its far end on.
    Rows up to the row less those before its window are its hits, so frames only ever grow: a frame that slides is
    counted anew for each row. Rows with a null time have each other in their window, and no others."""
    width = seconds * 1_000_000
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    rows = requests.withColumn("__at", at).withColumn("__slot", F.floor(at / width)).withColumn("__kind", F.lit("own")).withColumn("__of", F.col("__at"))
    # every row is also a mark in the next slot, which counts there, and asks once for what is before its window
    timed = rows.where("__at is not null")
    marks = timed.select(*by, (F.col("__slot") + 1).alias("__slot"), "__at", F.lit("mark").alias("__kind"))
    asks = timed.select(*by, "__slot", (F.col("__at") - width - 1).alias("__at"), F.lit("ask").alias("__kind"), F.col("__at").alias("__of"))
    every = rows.unionByName(marks, allowMissingColumns=True).unionByName(asks, allowMissingColumns=True)
    slot = W.partitionBy(*by, "__slot")
    counted = every.withColumn("__n", F.count(F.when(F.col("__kind") != "ask", 1)).over(slot.orderBy("__at"))).where("__kind <> 'mark'")
    before = F.max(F.when(F.col("__kind") == "ask", F.col("__n"))).over(slot.orderBy("__of"))  # grows with time, so the latest is the greatest
    out = counted.withColumn(name, F.col("__n") - F.coalesce(before, F.lit(0))).where("__kind = 'own'")
    return out.drop("__at", "__slot", "__kind", "__of", "__n")


def breaches(rates: DataFrame, limits: DataFrame) -> DataFrame:
    """category, client, first_at, worst of clients that went over their limit, and, with null client, of categories."""
    over = rates.join(F.broadcast(limits), "category")  # a row per category of the profile
    clients = over.where("client_hits > per_client").groupBy("category", "client").agg(F.min("ts").alias("first_at"), F.max("client_hits").alias("worst"))
    whole = over.where("category_hits > total").groupBy("category").agg(F.min("ts").alias("first_at"), F.max("category_hits").alias("worst"))
    return clients.unionByName(whole.withColumn("client", F.lit(None).cast("string")))


def snapshot(requests: DataFrame, now: Column, seconds: int = 60, top: int = 5) -> DataFrame:
    """category, hits, top_clients (name and hits of the busiest) in the window that ends now."""
    inside = requests.where((F.col("ts").cast("timestamp") >= now - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(seconds))) & (F.col("ts").cast("timestamp") <= now))
    per = inside.groupBy("category", "client").agg(F.count("*").alias("hits")).withColumn("slot", F.pmod(F.xxhash64("client"), F.lit(64)))
    # clients of a category are ranked slot by slot, then the best of each slot
    first = per.withColumn("r", F.row_number().over(W.partitionBy("category", "slot").orderBy(F.desc("hits"), "client")))
    best = F.collect_list(F.when(F.col("r") <= top, F.struct((-F.col("hits")).alias("less"), "client", "hits")))
    slots = first.groupBy("category", "slot").agg(F.sum("hits").alias("hits"), best.alias("best"))
    ranked = slots.groupBy("category").agg(F.sum("hits").alias("hits"), F.slice(F.array_sort(F.flatten(F.collect_list("best"))), 1, top).alias("best"))
    return ranked.select("category", "hits", F.array_join(F.transform("best", lambda x: F.concat_ws("=", x["client"], x["hits"])), ",").alias("top_clients"))


@dataclass(frozen=True)
class ScaleLimits:
    least: int = 2
    most: int = 6
    up: float = 0.8
    down: float = 0.2
    cooldown_seconds: int = 120


def scale_decision(limits: ScaleLimits | None = None) -> Column:
    """up, down or hold from total_cores, used_cores, alive, waiting, active, scaled, since_last (seconds, null if never)."""
    limits = limits or ScaleLimits()
    c = F.col
    use = F.when(c("total_cores") > 0, c("used_cores") / c("total_cores")).otherwise(0.0)
    busy = (c("waiting") > 0) | (use >= limits.up)
    idle = (use <= limits.down) & (c("active") == 0) & (c("alive") > limits.least) & (c("scaled") > 0)
    return (
        F.when(c("since_last") < limits.cooldown_seconds, "hold").when(c("alive") < limits.least, "up").when(busy & (c("alive") < limits.most), "up")
        .when(busy, "hold").when(idle, "down").otherwise("hold")
    )


def worker_colour(state: Column) -> Column:
    s = F.upper(F.coalesce(state, F.lit("")))
    return F.when(s == "ALIVE", "healthy").when(s.isin("DEAD", "DECOMMISSIONED", "KILLED"), "unhealthy").otherwise("warning")


def pipeline_kind(trigger: Column) -> Column:
    """child if an asset starts it, else mother."""
    return F.when(trigger == "asset", "child").otherwise("mother")
