"""Writers: files, keyed tables with replace-on-key, the batch lake, messages, exports."""
