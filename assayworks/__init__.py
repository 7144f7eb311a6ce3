"""Spark-first evaluation of agent conversations, plus corpus preparation operators."""
