"""No operator here is a stream: all inputs are whole tables."""
