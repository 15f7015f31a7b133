"""Sentiment analytics over short user messages, written as plain DataFrame functions on Spark."""
