"""End-to-end jobs: each turns source tables into one published table."""
