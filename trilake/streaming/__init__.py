from trilake.streaming.incremental import current_table, incremental_tables, incremental_trusted, run_incremental, snapshot  # noqa: F401
