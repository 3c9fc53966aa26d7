"""Readers and writers."""

from .corpus import (
    build_corpus,
    flatten_documents,
    parse_documents,
    read_documents,
    read_documents_in_splits,
    read_truth,
    task_label,
)
from .model_store import fingerprint, stored_model
from .models import read_model
from .posts import read_posts, read_posts_in_splits, read_table, write_csv, write_one_csv, write_table
from .search_index import SearchIndex, read_search_index, write_search_index

__all__ = [
    "SearchIndex",
    "build_corpus",
    "fingerprint",
    "flatten_documents",
    "parse_documents",
    "read_documents",
    "read_documents_in_splits",
    "read_model",
    "read_posts",
    "read_posts_in_splits",
    "read_search_index",
    "read_table",
    "read_truth",
    "stored_model",
    "task_label",
    "write_csv",
    "write_one_csv",
    "write_search_index",
    "write_table",
]
