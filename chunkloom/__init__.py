"""chunkloom: pages and documents to retrieval-ready chunks, as Spark jobs."""
