"""The named queries registered for the driver.

queries       one function per query (spark, sf_dir) -> DataFrame, each with
              the DuckDB SQL that must give the same rows
sql_snippets  SQL fragments shared by several of those twins
tables        reading the driver's Parquet tables
"""
