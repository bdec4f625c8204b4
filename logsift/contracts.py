"""Field contracts and cleaning thresholds.

A contract is an ordered list of ``FieldRule``.  It yields a ``StructType``
for typed reads and the check expressions used by validation.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import types as T


@dataclass(frozen=True)
class FieldRule:
    name: str
    dtype: str                      # 'datetime' | 'string' | 'float' | 'integer'
    required: bool = True
    nullable: bool = False
    min: float | int | None = None
    max: float | int | None = None
    allowed: tuple[Any, ...] | None = None
    pattern: str | None = None
    min_len: int | None = None
    max_len: int | None = None

    @property
    def spark_type(self) -> T.DataType:
        return {
            "datetime": T.TimestampType(),
            "string": T.StringType(),
            "float": T.DoubleType(),
            "integer": T.LongType(),
        }[self.dtype]

    @property
    def numeric(self) -> bool:
        return self.dtype in ("float", "integer")


@dataclass(frozen=True)
class Contract:
    name: str
    fields: tuple[FieldRule, ...]
    extra: dict = field(default_factory=dict)

    def __iter__(self):
        return iter(self.fields)

    def names(self) -> list[str]:
        return [f.name for f in self.fields]

    def get(self, name: str) -> FieldRule | None:
        for f in self.fields:
            if f.name == name:
                return f
        return None

    def struct_type(self) -> T.StructType:
        return T.StructType([T.StructField(f.name, f.spark_type, True) for f in self.fields])


# ---------------------------------------------------------------------------
# These must equal the reference's contract for equal results.
# ---------------------------------------------------------------------------
LOG_LEVELS = ("INFO", "WARNING", "ERROR", "DEBUG", "CRITICAL")
NAMESPACES = ("default", "production", "staging", "development", "monitoring", "kube-system")
ANOMALY_TYPES = ("normal", "cpu_spike", "memory_leak", "pod_crash",
                 "network_flood", "disk_io_bottleneck", "system_anomaly", "security_attack")
POD_NAME_PATTERN = r"^[a-z0-9]([-a-z0-9]*[a-z0-9])?(\.[a-z0-9]([-a-z0-9]*[a-z0-9])?)*$"
NAMESPACE_PATTERN = r"^[a-z0-9]([-a-z0-9]*[a-z0-9])?$"
NODE_NAME_PATTERN = r"^node-\d+$"

K8S_LOG = Contract("k8s_log", (
    FieldRule("timestamp", "datetime"),
    FieldRule("log_level", "string", allowed=LOG_LEVELS),
    FieldRule("message", "string", min_len=1, max_len=10000),
    FieldRule("pod_name", "string", pattern=POD_NAME_PATTERN),
    FieldRule("namespace", "string", allowed=NAMESPACES),
    FieldRule("container_name", "string", min_len=1, max_len=253),
    FieldRule("node_name", "string", pattern=NODE_NAME_PATTERN),
    FieldRule("service", "string"),
    FieldRule("cpu_usage_percent", "float", min=0.0, max=100.0),
    FieldRule("memory_usage_mb", "float", min=0.0, max=100000.0),
    FieldRule("network_bytes", "integer", min=0),
    FieldRule("is_anomaly", "integer", allowed=(0, 1)),
    FieldRule("anomaly_type", "string", allowed=ANOMALY_TYPES),
))

HYBRID = Contract("hybrid_dataset", (
    FieldRule("cpu_usage", "float", nullable=True, min=0.0, max=100.0),
    FieldRule("memory_usage", "float", nullable=True, min=0.0, max=100000.0),
    FieldRule("label", "integer", allowed=(0, 1)),
    FieldRule("anomaly_type", "string"),
    FieldRule("packets_count", "float", required=False, nullable=True, min=0.0),
    FieldRule("flow_bytes_per_second", "float", required=False, nullable=True, min=0.0),
    FieldRule("flow_packets_per_second", "float", required=False, nullable=True, min=0.0),
    FieldRule("container_cpu_usage_seconds_rate", "float", required=False, nullable=True, min=0.0),
    FieldRule("container_memory_usage_bytes", "float", required=False, nullable=True, min=0.0),
    FieldRule("anomaly_type_encoded", "integer", required=False, nullable=True),
))

# Cleaning thresholds (fixed values).
OUTLIER_FIELDS = ("cpu_usage_percent", "memory_usage_mb", "network_bytes")
OUTLIER_K_CLEANING = 3.0
OUTLIER_K_AUDIT = 1.5
CRITICAL_FIELDS = ("timestamp", "log_level", "message", "pod_name", "namespace")
MAX_MISSING_PCT = 5.0
DUPLICATE_KEYS = ("timestamp", "pod_name", "message")
DUPLICATE_WINDOW_SECONDS = 1
MAX_MESSAGE_LENGTH = 10000
TIMESTAMP_INPUT_FORMATS = (
    "%Y-%m-%dT%H:%M:%S.%f",
    "%Y-%m-%dT%H:%M:%S",
    "%Y-%m-%d %H:%M:%S.%f",
    "%Y-%m-%d %H:%M:%S",
    "%Y-%m-%dT%H:%M:%S.%f%z",
    "%Y-%m-%dT%H:%M:%S%z",
    "%Y-%m-%dT%H:%M:%S.%fZ",
    "%Y-%m-%dT%H:%M:%SZ",
)
ISO_OUTPUT_PATTERN = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"

# Quality gates (value, threshold, direction).
GATES = (
    ("retention_rate", 95.0, ">="),
    ("missing_rate", 5.0, "<="),
    ("duplicate_rate", 5.0, "<="),
    ("outlier_rate", 1.0, "<="),
)

# Server status rule thresholds (cpu as a fraction, memory in MB, anomaly count).
STATUS_CRITICAL = {"cpu": 0.8, "mem": 150000.0, "anomalies": 580}
STATUS_WARNING = {"cpu": 0.6, "mem": 100000.0, "anomalies": 550}

# Severity rank used for ordering/sizing (warning is not in the map -> 0).
SEVERITY_RANK = {"critical": 4, "high": 3, "medium": 2, "low": 1, "info": 0}
SEVERITY_DISPLAY_ORDER = ("critical", "high", "warning", "medium", "low", "info")


def contract_for(data_type: str) -> Contract:
    """Contract lookup; an unknown name falls back to the log contract."""
    return {"k8s_log": K8S_LOG, "hybrid_dataset": HYBRID}.get(data_type, K8S_LOG)
