"""Row layouts of the data model, as DDL.  Coordinates are 0-based and inclusive, strands explicit; sinks convert."""

from __future__ import annotations

CONTIGS = "contig_idx int, contig_id string, header string, length bigint"
CHUNKS = "contig_idx int, contig_id string, chunk_start bigint, seq string"
READS = "read_id string, panel int, x int, y int, tag string, primer string, colors string, ordinal bigint"
HITS = "read_id string, split_no int, contig_idx int, pos0 bigint, strand string, mm int"
INSERTIONS = "array<struct<pos:int,len:int>>"
ALIGNMENTS = f"read_id string, split_no int, contig_idx int, pos0 bigint, strand string, read_start int, aln_len int, score int, mm int, va array<int>, ins_read {INSERTIONS}, ins_ref {INSERTIONS}"
FEATURES = "contig_id string, source string, ftype string, start1 bigint, end1 bigint, score string, strand string, phase string, attributes string"
EXONS = "contig_id string, strand string, start1 bigint, end1 bigint, gene_id string, transcript_id string"
TRANSCRIPTS = "bin int, name string, chrom string, strand string, tx_start bigint, tx_end bigint, cds_start bigint, cds_end bigint, exon_count int, exon_starts array<bigint>, exon_ends array<bigint>, id int, name2 string, cds_start_stat string, cds_end_stat string, exon_frames array<int>"
JUNCTIONS = "junction_no int, contig_id string, gene_id string, strand string, left_start1 bigint, left_end1 bigint, right_start1 bigint, right_end1 bigint, is_known boolean, seq string"
COVERAGE = "contig_id string, strand string, start0 bigint, end0_excl bigint, depth bigint"
SEEDS = "len int, mismatches int, adj boolean, pattern_id int, mask string"
SUMMARY = "window bigint, min_coverage bigint, n_ptr bigint, n_atr bigint, n_ptr_matched bigint, n_atr_matched bigint, ptr_fraction double, atr_fraction double, mean_ptr_overlap double, mean_atr_overlap double, bases bigint"
