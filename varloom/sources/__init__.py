"""Readers: file listings, VCF text (plain, gzip, block-gzip) and columnar tables."""
