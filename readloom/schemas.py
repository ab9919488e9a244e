"""Schemas of the domain's tables. Coordinates are 1-based and closed; only sources and sinks convert."""

from __future__ import annotations

SAM = "query_name string, flag int, ref string, pos long, mapq int, cigar string, mate_ref string, mate_pos long, insert_size string, seq string, qual string, tags string"
BED6 = "chrom string, start0 long, end0 long, name string, score double, strand string"
INTERSECTION = "chrom string, start0 long, end0 long, name string, score double, strand string, exon_chrom string, exon_start0 long, exon_end0 long, exon_id string, exon_score string, exon_strand string, overlap int"
GTF = "seqname string, source string, feature string, start long, end long, score string, strand string, frame string, attributes string"
WEIGHTS = "fragment string, num_alignments int, sum_edit_distance int, kind string, spliced int, soft_clipped int"
OBJECT_MAP = "exon_id string, object_id string, internal_id string"
TRANSCRIPT_MAP = "transcript_id string, gene_id string, position long"
LENGTHS = "id string, length long"
FASTQ = "full_id string, read_id string, fragment_id string, read_index int, multiplicity int, seq string, qual string"
#: Alignment kinds of a weight table, best last.
KINDS = ("single-read", "single-read (both)", "paired-end")
