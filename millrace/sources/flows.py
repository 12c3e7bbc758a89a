"""Schema of the network-flow CSV files (read by position)."""

from __future__ import annotations

from pyspark.sql import types as T

# Column names, order and types of the published flow files.
_FLOW_COLUMNS = """
Destination Port: int
Flow Duration: int
Total Fwd Packets: int
Total Backward Packets: int
Total Length of Fwd Packets: int
Total Length of Bwd Packets: int
Fwd Packet Length Max: int
Fwd Packet Length Min: int
Fwd Packet Length Mean: double
Fwd Packet Length Std: double
Bwd Packet Length Max: int
Bwd Packet Length Min: int
Bwd Packet Length Mean: double
Bwd Packet Length Std: double
Flow Bytes/s: double
Flow Packets/s: double
Flow IAT Mean: double
Flow IAT Std: double
Flow IAT Max: int
Flow IAT Min: int
Fwd IAT Total: int
Fwd IAT Mean: double
Fwd IAT Std: double
Fwd IAT Max: int
Fwd IAT Min: int
Bwd IAT Total: int
Bwd IAT Mean: double
Bwd IAT Std: double
Bwd IAT Max: int
Bwd IAT Min: int
Fwd PSH Flags: int
Bwd PSH Flags: int
Fwd URG Flags: int
Bwd URG Flags: int
Fwd Header Length: bigint
Bwd Header Length: int
Fwd Packets/s: double
Bwd Packets/s: double
Min Packet Length: int
Max Packet Length: int
Packet Length Mean: double
Packet Length Std: double
Packet Length Variance: double
FIN Flag Count: int
SYN Flag Count: int
RST Flag Count: int
PSH Flag Count: int
ACK Flag Count: int
URG Flag Count: int
CWE Flag Count: int
ECE Flag Count: int
Down/Up Ratio: int
Average Packet Size: double
Avg Fwd Segment Size: double
Avg Bwd Segment Size: double
Fwd Header Length.1: bigint
Fwd Avg Bytes/Bulk: int
Fwd Avg Packets/Bulk: int
Fwd Avg Bulk Rate: int
Bwd Avg Bytes/Bulk: int
Bwd Avg Packets/Bulk: int
Bwd Avg Bulk Rate: int
Subflow Fwd Packets: int
Subflow Fwd Bytes: int
Subflow Bwd Packets: int
Subflow Bwd Bytes: int
Init_Win_bytes_forward: int
Init_Win_bytes_backward: int
act_data_pkt_fwd: int
min_seg_size_forward: int
Active Mean: double
Active Std: double
Active Max: int
Active Min: int
Idle Mean: double
Idle Std: double
Idle Max: int
Idle Min: int
Label: string
"""

_TYPES = {"int": T.IntegerType(), "bigint": T.LongType(), "double": T.DoubleType(), "string": T.StringType()}


def flow_schema() -> T.StructType:
    """79 nullable columns; use with ``scan_csv(schema=...)``."""
    pairs = (line.rsplit(": ", 1) for line in _FLOW_COLUMNS.strip().splitlines())
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])
