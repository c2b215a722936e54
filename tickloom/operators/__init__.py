"""Transforms over ticks, candles and bars."""
