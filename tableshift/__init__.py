"""tableshift: move, release and reconcile sets of tables on Spark, and prove nothing was lost."""

__version__ = "0.1.0"
