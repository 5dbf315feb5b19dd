"""Readers: folders of PDFs, page tables, the correction cache."""
