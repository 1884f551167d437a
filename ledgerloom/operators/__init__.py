"""DataFrame -> DataFrame operations.

attributes  value counts per text column, auto-completion, trigram similarity
timedim     day, duration and hour-of-day dimensions
series      gap fill of sparse rate quotes, base rows, rate lookup join
checks      data checks returning report rows; ``enforce`` raises
enums       ordered label dictionaries
sketches    HyperLogLog sketches and roll-ups
chunks      chunk ids, chunk selection and layout
ordinals    consecutive numbering without a single-partition window
"""
