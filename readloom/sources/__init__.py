"""Readers and writers. Paths go to Spark's own readers, so compressed and remote files work alike."""
