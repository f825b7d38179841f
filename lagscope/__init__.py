"""Playback quality analytics over live-video player logs, on Spark DataFrames."""
