"""Writers of curated records, summaries and run documents."""
