from tillroll.streaming.checks import stream_row_checks, stream_sales_by_payment, write_batches

__all__ = ["stream_row_checks", "stream_sales_by_payment", "write_batches"]
