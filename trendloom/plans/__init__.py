"""End-to-end jobs: ETL (E1), aggregate build (E2), genre share (E3), report feeds."""
