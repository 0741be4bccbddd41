"""Runnable jobs: tables in, tables out."""
