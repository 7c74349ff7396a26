"""scriptorium — a Spark-native literature warehouse.

Turns text-mining output about scientific papers into a snowflake-schema
warehouse (dimensions, group + bridge tables, a closure table, one fact table)
and a wide per-paper summary, using only DataFrame / SQL operators.

Sub-packages:
  functions  column expressions (cleaning, parsing, weights)
  operators  reusable table operators (keys, delta, mode, closure, ...)
  sources    readers and checked writers
  plans      the ETL plans for each warehouse table and the ordered full load
  streaming  (the reference is batch only; see its docstring)
"""

__version__ = "0.1.0"
