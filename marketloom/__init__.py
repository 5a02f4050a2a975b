"""Spark-native product catalog engine and corpus tools: functions from DataFrames to DataFrames."""
