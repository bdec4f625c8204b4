"""Small inline inputs (FIXTURES.md F-1 .. F-3)."""

from pyspark.sql import functions as F

LOG_COLS = ("timestamp string, log_level string, message string, pod_name string, namespace string, "
            "container_name string, node_name string, service string, cpu_usage_percent double, "
            "memory_usage_mb double, network_bytes long, is_anomaly long, anomaly_type string")

LOGS_SMALL = [
    ("2024-01-01T12:02:00", "INFO", "Pod started", "test-pod-123", "default", "container-1", "node-1", "frontend",
     50.0, 1024.0, 100000, 0, "normal"),
    ("2024-01-01T12:01:00", "WARNING", "High CPU usage", "test-pod-456", "production", "container-2", "node-2",
     "backend", 85.0, 2048.0, 500000, 1, "cpu_spike"),
    ("2024-01-01T12:00:00", "ERROR", "Pod crashed", "test-pod-789", "staging", "container-3", "node-3", "database",
     95.0, 4096.0, 1000000, 1, "pod_crash"),
]


def logs_small(spark, rows=None):
    rows = rows if rows is not None else LOGS_SMALL
    df = spark.createDataFrame(rows, LOG_COLS)
    return df.withColumn("log_id", F.monotonically_increasing_id())


def with_pos(df):
    return df.withColumn("log_id", F.monotonically_increasing_id())
