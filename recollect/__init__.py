"""Agent memory, retrieval, sync and feature jobs as plain PySpark DataFrame functions."""
