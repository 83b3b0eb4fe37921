"""Composed jobs: batch layers, file ingest, quality gate, feature definitions, registered queries."""
