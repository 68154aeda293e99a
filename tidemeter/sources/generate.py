"""Synthetic events, one per input row, repeatable for a seed.

Every value is a hash of (seed, key, field) mapped into its range, so a lost partition is rebuilt with
the same values and the generator scales with its input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- Fixed values: the fields of each source kind, in order -----------------------------------
# (name, low, high) is drawn between both ends, whole if they are whole; (name, text or number) is a
# constant; a name alone is one of the texts or derived numbers below.
FIELDS = {
    "cpu_data": (
        ("cpu", "cpu-total"),
        "host",
        ("usage_idle", 75.0, 95.0),
        ("usage_iowait", 0.0, 1.0),
        ("usage_system", 1.0, 4.0),
        ("usage_user", 4.0, 20.0),
    ),
    "gpu_data": (
        ("compute_mode", "Default"),
        "host",
        ("index", 0),
        ("name", "NVIDIA GeForce RTX 2080"),
        ("pstate", "P8"),
        "uuid",
        ("fan_speed", 0, 20),
        ("memory_free", 7000, 7400),
        ("memory_reserved", 350, 500),
        ("memory_total", 8192),
        ("memory_used", 400, 700),
        ("temperature_gpu", 40, 65),
        ("utilization_gpu", 0, 40),
        ("utilization_memory", 0, 20),
    ),
    "gpu_proc_data": (
        ("gpu_idx", 0),
        "host",
        ("mem_util", "-"),
        ("pid", 1000, 9999),
        ("sm_util", "-"),
    ),
    "mem_data": ("host", "available", "mem_total", "used"),
    "net_data": (
        "host",
        "comm",
        ("dport", 1024, 65535),
        "laddr",
        ("lport", 1024, 65535),
        ("pid", 100, 9999),
        "raddr",
        ("rx_kb", 0, 1024),
        ("tx_kb", 0, 1024),
    ),
    "sys_data": (
        "host",
        "load1",
        "load5",
        "load15",
        ("n_cpus", 2, 32),
        ("uptime", 100, 200_000),
    ),
    "disk_data": (
        "host",
        "device",
        "wwid",
        ("io_time", 1000, 100_000),
        ("iops_in_progress", 0),
        ("read_bytes", 1_000_000_000, 10_000_000_000),
        ("reads", 1000, 100_000),
        ("write_bytes", 1_000_000_000, 10_000_000_000),
        ("writes", 1000, 100_000),
    ),
    "proc_data": (
        "host",
        ("blocked", 0, 2),
        ("idle", 60, 90),
        "proc_total",
        ("running", 0, 4),
        ("sleeping", 200, 400),
        ("stopped", 0, 2),
        ("total_threads", 1000, 5000),
        ("zombies", 0, 2),
    ),
}
OTHER_FIELDS = ("host", "word")
MEMORY_GIB = (16, 64)
MEMORY_USED_SHARE = (0.12, 0.35)
LOAD = (0.1, 4.0)
LOAD_DROP = {"load5": (0.0, 0.5), "load15": (0.0, 0.4)}
LOWEST_LOAD = 0.01
OTHER_PROCESSES = (40, 80)
# ----------------------------------------------------------------------------------------------

SOURCE_KINDS = tuple(FIELDS)
# Fields that go by another name in the payload.
SHOWN_AS = {"device": "name", "word": "value"}

GIB = 1024**3
WORDS = ("alpha", "bridge", "copper", "delta", "ember", "fjord", "grove", "harbor")


class _Draw:
    """Hash-based draws for one row."""

    def __init__(self, key: Column, seed: int):
        self.key = key
        self.seed = seed

    def unit(self, field: str) -> Column:
        """A double in [0, 1)."""
        bits = F.xxhash64(F.lit(self.seed), F.lit(field), self.key)
        return F.shiftrightunsigned(bits, 11).cast("double") / F.lit(float(1 << 53))

    def real(self, field: str, low, high, digits: int = 12) -> Column:
        return F.round(F.lit(low) + self.unit(field) * (F.lit(high) - F.lit(low)), digits)

    def whole(self, field: str, low, high) -> Column:
        """An integer in [low, high], both ends included."""
        low, high = F.lit(low), F.lit(high)
        return F.floor(low + self.unit(field) * (high - low + 1)).cast("bigint")

    def word(self, field: str) -> Column:
        words = F.array(*[F.lit(word) for word in WORDS])
        return F.get(words, self.whole(field, 0, len(WORDS) - 1).cast("int"))

    def address(self, field: str) -> Column:
        parts = [self.whole(f"{field}{i}", 0, 255).cast("string") for i in range(3)]
        return F.concat_ws(".", F.lit("10"), *parts)

    def token(self, field: str) -> Column:
        return F.md5(F.concat_ws(":", F.lit(str(self.seed)), F.lit(field), self.key.cast("string")))

    def uuid(self, field: str) -> Column:
        return F.regexp_replace(self.token(field), "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")


def _between(kind: str, name: str) -> tuple:
    """Range of a field in the table above."""
    return next(field[1:] for field in FIELDS[kind] if field[0] == name)


class _Fields:
    """Values of one row's fields."""

    def __init__(self, draw: _Draw):
        self.draw = draw

    def value(self, field: str | tuple) -> Column:
        if isinstance(field, str):
            return getattr(self, field)()
        name, *spec = field
        if len(spec) == 1:
            return F.lit(spec[0])
        whole = all(isinstance(end, int) for end in spec)
        return self.draw.whole(name, *spec) if whole else self.draw.real(name, *spec)

    def host(self) -> Column:
        return F.concat(F.lit("host-"), F.substring(self.draw.token("host"), 1, 8))

    def uuid(self) -> Column:
        return F.concat(F.lit("GPU-"), self.draw.uuid("uuid"))

    def wwid(self) -> Column:
        return F.concat(F.lit("eui."), F.substring(self.draw.token("wwid"), 1, 16))

    def comm(self) -> Column:
        return self.draw.word("comm")

    def device(self) -> Column:
        return self.draw.word("device")

    def word(self) -> Column:
        return self.draw.word("word")

    def laddr(self) -> Column:
        return self.draw.address("laddr")

    def raddr(self) -> Column:
        return self.draw.address("raddr")

    def mem_total(self) -> Column:
        return self.draw.whole("mem_total", *MEMORY_GIB) * GIB

    def used(self) -> Column:
        return F.floor(self.mem_total() * self.draw.real("share", *MEMORY_USED_SHARE)).cast("bigint")

    def available(self) -> Column:
        return self.mem_total() - self.used()

    def load1(self) -> Column:
        return self.draw.real("load1", *LOAD, 2)

    def load5(self) -> Column:
        return self._lower(self.load1(), "load5")

    def load15(self) -> Column:
        return self._lower(self.load5(), "load15")

    def _lower(self, load: Column, name: str) -> Column:
        lowered = load - self.draw.real(name, *LOAD_DROP[name])
        return F.round(F.greatest(lowered, F.lit(LOWEST_LOAD)), 2)

    def proc_total(self) -> Column:
        states = ("running", "sleeping", "stopped", "zombies")
        parts = [self.draw.whole(name, *_between("proc_data", name)) for name in states]
        return sum(parts, self.draw.whole("other", *OTHER_PROCESSES))


def _metrics(kind: str, draw: _Draw) -> dict[str, Column]:
    fields = _Fields(draw)
    named = {}
    for field in FIELDS.get(kind, OTHER_FIELDS):
        name = field if isinstance(field, str) else field[0]
        named[SHOWN_AS.get(name, name)] = fields.value(field)
    return named


def generated_payload(kind: Column, key: Column, seed: int = 0) -> Column:
    """Metrics of the row's source kind as JSON text."""
    draw = _Draw(key, seed)

    def as_json(name: str) -> Column:
        return F.to_json(F.struct(*[c.alias(n) for n, c in _metrics(name, draw).items()]))

    payload = None
    for name in SOURCE_KINDS:
        branch = (kind == name, as_json(name))
        payload = F.when(*branch) if payload is None else payload.when(*branch)
    return payload.otherwise(as_json(""))


def generate_events(
    keys: DataFrame,
    key: str,
    kind: Column,
    origin: Column,
    device_name: Column,
    profile_name: Column,
    seed: int = 0,
) -> DataFrame:
    """One doubly encoded event per row of ``keys``: (key, source_name, event JSON text)."""
    named = keys.select(
        F.col(key),
        kind.alias("source_name"),
        origin.cast("bigint").alias("origin"),
        device_name.alias("device_name"),
        profile_name.alias("profile_name"),
    ).withColumn("payload", generated_payload(F.col("source_name"), F.col(key), seed))
    reading = F.struct(
        F.col("origin"),
        F.col("device_name").alias("deviceName"),
        F.col("source_name").alias("resourceName"),
        F.col("profile_name").alias("profileName"),
        F.lit("String").alias("valueType"),
        F.to_json(F.create_map("source_name", "payload")).alias("value"),
    )
    envelope = F.struct(
        F.lit("v3").alias("apiVersion"),
        _Draw(F.col(key), seed).uuid("id").alias("id"),
        F.col("device_name").alias("deviceName"),
        F.col("profile_name").alias("profileName"),
        F.col("source_name").alias("sourceName"),
        F.col("origin"),
        F.array(reading).alias("readings"),
    )
    return named.select(key, "source_name", F.to_json(envelope).alias("value"))
