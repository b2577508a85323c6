"""Streaming.

The reference has no streaming input, watermark, window or stateful operator, so
nothing here is registered. The feature operators are plain DataFrame functions;
a user who receives daily sales as a stream can apply them inside
`writeStream.foreachBatch` to each micro-batch unioned with the last 364 days of
history (the longest lookback), which is the same plan as the horizon features.
"""
