from gearbox.streaming.parts import clean_parts_stream, read_parts_stream, read_stream_output

__all__ = ["clean_parts_stream", "read_parts_stream", "read_stream_output"]
