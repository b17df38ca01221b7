from confluo.streaming.incremental import retailer_sales_stream, start_append

__all__ = ["retailer_sales_stream", "start_append"]
