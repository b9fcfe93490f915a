"""Table mappings and partition-plan settings, validated on the driver.

A mapping names a source table, a target table and the target key. The key
is split the way a partition-keyed store splits it: ``partition_key`` decides
which bucket (node) a row lives in, ``clustering_keys`` order rows inside it.
Row identity is the concatenation of both.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field


class MappingError(ValueError):
    """A table mapping or plan setting that cannot be executed."""


def _as_tuple(value: str | Iterable[str] | None, what: str) -> tuple[str, ...]:
    # A single string is one column name, never a sequence of letters.
    if value is None:
        return ()
    if isinstance(value, str):
        return (value,) if value else ()
    out = tuple(value)
    for v in out:
        if not isinstance(v, str) or not v:
            raise MappingError(f"{what}: column names must be non-empty strings, got {v!r}")
    return out


@dataclass(frozen=True)
class TableMapping:
    """Source table -> keyed target table.

    ``source_key`` is the primary key the source declares. When it is a subset
    of the target key, target rows are already unique and the upsert dedupe
    can be skipped. ``order_by`` decides which of several rows with one key
    wins (greatest wins); the remaining non-key columns break ties so that the
    choice is total and repeatable.
    """

    source: str
    target: str
    partition_key: tuple[str, ...]
    clustering_keys: tuple[str, ...] = ()
    source_key: tuple[str, ...] = ()
    order_by: tuple[str, ...] = ()
    buckets: int | None = None

    @classmethod
    def of(
        cls,
        source: str,
        target: str,
        partition_key: str | Sequence[str] | None,
        clustering_keys: str | Sequence[str] | None = None,
        source_key: str | Sequence[str] | None = None,
        order_by: str | Sequence[str] | None = None,
        buckets: int | None = None,
    ) -> "TableMapping":
        m = cls(
            source=source,
            target=target,
            partition_key=_as_tuple(partition_key, "partition_key"),
            clustering_keys=_as_tuple(clustering_keys, "clustering_keys"),
            source_key=_as_tuple(source_key, "source_key"),
            order_by=_as_tuple(order_by, "order_by"),
            buckets=buckets,
        )
        m.validate()
        return m

    @classmethod
    def from_dict(cls, d: dict) -> "TableMapping":
        return cls.of(
            source=d["source_table"] if "source_table" in d else d["source"],
            target=d["target_table"] if "target_table" in d else d["target"],
            partition_key=d.get("partition_key"),
            clustering_keys=d.get("clustering_keys"),
            source_key=d.get("source_key"),
            order_by=d.get("order_by"),
            buckets=d.get("buckets"),
        )

    @property
    def key(self) -> tuple[str, ...]:
        return self.partition_key + self.clustering_keys

    def validate(self, columns: Sequence[str] | None = None) -> None:
        if not self.source or not self.target:
            raise MappingError("a mapping needs a source and a target table")
        if not self.partition_key:
            raise MappingError(f"{self.target}: a partition key is required")
        dup = [c for c in self.key if self.key.count(c) > 1]
        if dup:
            raise MappingError(f"{self.target}: key column repeated: {sorted(set(dup))}")
        if self.buckets is not None and self.buckets < 1:
            raise MappingError(f"{self.target}: buckets must be >= 1")
        if columns is not None:
            wanted = set(self.key) | set(self.order_by) | set(self.source_key)
            missing = sorted(wanted - set(columns))
            if missing:
                raise MappingError(f"{self.target}: columns not in source: {missing}")

    def key_is_unique_by_source(self) -> bool:
        """True when the declared source key guarantees unique target keys."""
        return bool(self.source_key) and set(self.source_key) <= set(self.key)


@dataclass(frozen=True)
class PlanSettings:
    """Knobs of the size-driven partition plan (see plans.partition_plan).

    Fixed values (defaults of the reference's plan): repartition from 100,000
    rows, 50,000 rows per partition, small tables coalesced when they have
    more than 10 partitions, to at most 10 partitions of 10,000 rows.

    ``target_bucket_bytes`` sizes keyed tables by data volume instead of row
    count (wide rows get more buckets); the profile job then reads every
    column to measure it.
    """

    enable_repartition: bool = True
    repartition_threshold: int = 100_000
    target_partitions: int | None = None
    rows_per_partition: int = 50_000
    small_max_partitions: int = 10
    small_rows_per_partition: int = 10_000
    max_buckets: int = 100_000  # Spark's own default limit
    target_bucket_bytes: int | None = None
    enable_cache: bool = False

    def __post_init__(self) -> None:
        if self.rows_per_partition <= 0:
            raise MappingError("rows_per_partition must be > 0")
        if self.small_rows_per_partition <= 0:
            raise MappingError("small_rows_per_partition must be > 0")
        if self.small_max_partitions < 1 or self.max_buckets < 1:
            raise MappingError("partition bounds must be >= 1")
        if self.target_bucket_bytes is not None and self.target_bucket_bytes <= 0:
            raise MappingError("target_bucket_bytes must be > 0")
        if self.target_partitions is not None and self.target_partitions < 0:
            raise MappingError("target_partitions must be >= 0")

    @classmethod
    def from_dict(cls, d: dict | None) -> "PlanSettings":
        d = dict(d or {})
        known = {f for f in cls.__dataclass_fields__}
        return cls(**{k: v for k, v in d.items() if k in known})


@dataclass
class RunOptions:
    """Per-run switches of a migration.

    ``rejects`` names a shared folder: rows with a value that an existing
    table's types refuse are then written there, not failed on.
    """

    mode: str = "append"
    confirm_truncate: bool = True
    profile: str = "reference"
    reconcile: bool = False
    rejects: str | None = None
    extra: dict = field(default_factory=dict)
