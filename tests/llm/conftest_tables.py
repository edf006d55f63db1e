import os

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = ("documents", "pages", "benchmark", "labels", "embeddings")
