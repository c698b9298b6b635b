"""Table schemas shared by sources and operators (0-based half-open coordinates)."""

from pyspark.sql import types as T

READS = T.StructType.fromDDL(
    "sample STRING, read_idx BIGINT, mate TINYINT, qname STRING, descr STRING, seq STRING, qual STRING"
)
SEQUENCES = T.StructType.fromDDL("name STRING, descr STRING, seq STRING, length BIGINT")
ALIGNMENTS = T.StructType.fromDDL(
    "sample STRING, qname STRING, flag INT, rname STRING, pos INT, mapq INT, cigar STRING, rnext STRING,"
    " pnext INT, tlen INT, seq STRING, qual STRING, tags MAP<STRING, STRUCT<type: STRING, value: STRING>>"
)
FEATURES = T.StructType.fromDDL(
    "source STRING, rname STRING, start INT, end INT, feature STRING, score STRING, strand STRING,"
    " frame STRING, gene_id STRING, transcript_id STRING, exon_number INT, attrs MAP<STRING, STRING>"
)
INTERVALS = T.StructType.fromDDL(
    "sample STRING, rname STRING, start INT, end INT, name STRING, score DOUBLE, strand STRING"
)
SIGNAL = T.StructType.fromDDL("sample STRING, rname STRING, start INT, end INT, value DOUBLE")
COUNTS = T.StructType.fromDDL(
    "sample STRING, target_id STRING, length DOUBLE, eff_length DOUBLE, count DOUBLE, tpm DOUBLE"
)
SAMPLES = T.StructType.fromDDL(
    "sample STRING, index_r1 STRING, index_r2 STRING, lane INT, project STRING, attrs MAP<STRING, STRING>"
)
CHROM_SIZES = T.StructType.fromDDL("rname STRING, length BIGINT")
MANIFEST = T.StructType.fromDDL("path STRING, size BIGINT, mtime TIMESTAMP, sha256 STRING")
