"""Operators: functions from DataFrames to DataFrames.

Three habits keep them usable on very large tables:

* Sums and counts are taken per join key before the join. Each join then meets a key
  once on either side, so a key that holds a third of the rows is folded by the
  map-side combine and never lands in one task. It costs no extra shuffle, because
  the aggregate already leaves the rows partitioned the way the join needs them.
* Where single rows must be joined, the join is a plain equi-join that feeds another
  shuffle or a write, which is the case adaptive execution can split when skewed.
* No broadcast hint is given on tables. Spark broadcasts a side when its measured size
  is under the session's threshold and shuffles it otherwise.
"""
