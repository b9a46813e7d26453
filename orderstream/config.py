"""Settings of a deployment, one frozen object handed to every job."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field, fields, replace
from typing import Any

# Property names of an existing deployment's settings file and
# the field each one fills.
PROPERTIES: dict[str, str] = {
    "app.is.local": "local_mode",
    "app.spark.master": "master",
    "kafka.bootstrap.servers": "bootstrap_servers",
    "kafka.auto.offset.reset": "offset_reset",
    "kafka.source.topics": "source_topic",
    "kafka.etl.topic": "etl_topic",
    "kafka.max.offsets.per.trigger": "max_offsets_per_trigger",
    "streaming.etl.group.id": "etl_group_id",
    "streaming.etl.ckpt": "etl_checkpoint",
    "streaming.amt.total.ckpt": "amt_total_checkpoint",
    "streaming.amt.province.ckpt": "amt_province_checkpoint",
    "streaming.amt.city.ckpt": "amt_city_checkpoint",
    "stop.etl.file": "stop_etl_file",
    "stop.state.file": "stop_state_file",
    "redis.host": "store_host",
    "redis.port": "store_port",
    "redis.db": "store_db",
    "ipdata.region.path": "region_path",
}

# The nine key cities of the key-city report.
KEY_CITIES: tuple[str, ...] = (
    "北京市", "上海市", "深圳市", "广州市", "杭州市", "成都市", "南京市", "武汉市", "西安市",
)

# Spellings of the start position accepted from older settings files.
_OFFSETS = {"largest": "latest", "latest": "latest", "smallest": "earliest", "earliest": "earliest"}


@dataclass(frozen=True)
class Settings:
    # The 18 properties of PROPERTIES. Topic names, rate and port.
    local_mode: bool = True
    master: str = "local[*]"
    bootstrap_servers: str = "localhost:9092"
    offset_reset: str = "largest"
    source_topic: str = "orderTopic"
    etl_topic: str = "orderEtlTopic"
    max_offsets_per_trigger: int = 10000
    etl_group_id: str = ""
    etl_checkpoint: str = ""
    amt_total_checkpoint: str = ""
    amt_province_checkpoint: str = ""
    amt_city_checkpoint: str = ""
    stop_etl_file: str = ""
    stop_state_file: str = ""
    store_host: str = ""
    store_port: int = 6379
    store_db: int = 0
    region_path: str = ""

    # Where messages come from: "kafka", or "files" for a folder of Parquet segments.
    source_format: str = "kafka"
    topic_root: str = ""
    # Most that a batch takes from a file topic: files, or else bytes, or else the files
    # that hold at most max_offsets_per_trigger messages.
    max_files_per_trigger: int | None = None
    max_bytes_per_trigger: int | None = None
    # Where a file topic begins: earliest, latest (segments that come after the first
    # start with this checkpoint_root), or after segments of a time, e.g. 2024-11-06T00:00:00Z.
    file_start: str = "earliest"
    # Messages before this time are passed over, e.g. 2024-11-06T00:00:00Z (empty: none are).
    starting_time: str = ""
    # Split a large topic partition over several tasks (0 = one task per partition).
    min_partitions: int = 0

    # Checkpoints not named above go under this folder, one per query.
    checkpoint_root: str = ""
    # Frozen into a checkpoint at its first start, so chosen before that.
    state_partitions: int = 4
    state_store: str = "default"  # or "rocksdb"
    trigger: Mapping[str, Any] = field(default_factory=dict)
    shuffle_partitions: int = 3  # local mode only; clusters set their own

    key_cities: tuple[str, ...] = KEY_CITIES
    # Keyed results: our Parquet hash table, or any DataFrame sink of the deployment.
    store_path: str = ""
    # A table of every batch the queries run, if wanted.
    batch_table: str = ""
    store_format: str = "hashes"
    store_options: Mapping[str, str] = field(default_factory=dict)

    # Dictionary lookup: largest index that may be broadcast.
    geo_broadcast_bytes: int = 512 * 1024 * 1024
    # Format of the dictionary table: a DataFrame source, csv with a header.
    region_format: str = "parquet"

    @property
    def starting_offsets(self) -> str:
        return _OFFSETS[self.offset_reset]

    def checkpoint(self, query: str) -> str:
        """Checkpoint folder of a query; never shared between two queries."""
        named = {
            "order-etl": self.etl_checkpoint,
            "query-amt-total": self.amt_total_checkpoint,
            "query-amt-province": self.amt_province_checkpoint,
            "query-amt-city": self.amt_city_checkpoint,
        }.get(query, "")
        if named:
            return named
        if not self.checkpoint_root:
            raise ValueError(f"no checkpoint folder for query {query!r}: set checkpoint_root")
        return f"{self.checkpoint_root.rstrip('/')}/{query}"

    @classmethod
    def from_properties(cls, text: str, **overrides: Any) -> Settings:
        """Read ``key=value`` lines: the names in PROPERTIES or field names of this class.

        Any other name is refused. Comments start with # or !. Key cities are separated
        by commas, ``trigger`` is ``availableNow`` or ``processingTime: 5 seconds``, and
        ``store_options.<name>`` sets one option of the store.
        """
        kinds = {f.name: f.type for f in fields(cls)}
        values: dict[str, Any] = {}
        options: dict[str, str] = {}
        unknown = []
        for raw in text.splitlines():
            line = raw.strip()
            if not line or line[0] in "#!" or "=" not in line:
                continue
            key, value = (part.strip() for part in line.split("=", 1))
            name = PROPERTIES.get(key, key)
            kind = kinds.get(name, "")
            if key.startswith("store_options."):
                options[key.partition(".")[2]] = value
            elif name == "trigger":
                values[name] = _trigger(value)
            elif kind == "bool":
                values[name] = _boolean(key, value)
            elif kind in ("int", "int | None"):
                values[name] = int(value)
            elif kind == "tuple[str, ...]":
                values[name] = tuple(part.strip() for part in value.split(","))
            elif kind == "str":
                values[name] = value
            else:
                unknown.append(key)
        if unknown:
            raise ValueError(f"unknown settings: {', '.join(unknown)}")
        if options:
            values["store_options"] = options
        return replace(cls(**values), **overrides)


def _trigger(value: str) -> dict[str, Any]:
    kind, _, interval = (part.strip() for part in value.partition(":"))
    if kind == "availableNow" and not interval:
        return {kind: True}
    if kind in ("processingTime", "continuous") and interval:
        return {kind: interval}
    raise ValueError(f"trigger: neither availableNow nor an interval: {value!r}")


def _boolean(key: str, value: str) -> bool:
    lowered = value.lower()
    if lowered in ("true", "yes", "on"):
        return True
    if lowered in ("false", "no", "off"):
        return False
    raise ValueError(f"{key}: not a boolean: {value!r}")
