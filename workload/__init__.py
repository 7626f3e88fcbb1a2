"""The library's operators as queries over the benchmark tables, with SQL for comparison."""
