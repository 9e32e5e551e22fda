"""Request messages: parsing, validation, de-duplication, responses, the stream."""
