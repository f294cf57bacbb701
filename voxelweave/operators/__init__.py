"""DataFrame -> DataFrame operators over volumes, tiles, labels and objects."""
